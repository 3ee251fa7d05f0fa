"""Token ids of a byte-level BPE file, inside tasks.

The file is the tokenizers library's JSON.  Its ranks are handed to tiktoken's merge
loop, which gives the same ids (a test compares both over odd Unicode) at about five
times the speed per core; `engine="tokenizers"` uses the library itself.  The loop's pattern
matcher panics at a million white-space characters in a row, so texts with runs that
come near go through the library too.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable

import numpy as np

WHITE = 1 << 18  # characters; a run of twice as many holds a whole aligned piece of white space


@functools.lru_cache(maxsize=4)
def encoder(path: str, engine: str = "ranks") -> Callable[[str], list[int]]:
    """Text to ids without added special tokens; a special token's string in a text is that token."""
    if engine == "tokenizers":
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        return lambda text: model.encode(text, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
    to_byte = _printable_bytes()
    ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    coding = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    names = list(special)

    def encode(text: str) -> list[int]:
        if len(text) >= WHITE and any(text[i : i + WHITE].isspace() for i in range(0, len(text) - WHITE + 1, WHITE)):
            return encoder(path, "tokenizers")(text)
        return coding.encode(text, allowed_special="all") if any(n in text for n in names) else coding.encode_ordinary(text)

    return encode


def ids_with_end(encode: Callable[[str], list[int]], text: str | None, end: int) -> np.ndarray:
    ids = encode(text or "")
    ids.append(end)
    return np.array(ids, dtype=np.uint32)


def _printable_bytes() -> dict[str, int]:
    """Byte-level alphabets write a byte as itself where it is visible, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
