from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, with_clashing_columns
from tokenizers import Tokenizer

from tallyforge.llm import tokens
from tallyforge.llm.huffman import Codebook, code_lengths
from tallyforge.llm.packing import SumOfSquares, pack_documents
from tallyforge.llm.token_files import BLOCK, EVERY, read_checksums, read_codebook, read_token_files, write_token_files

BPE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", "Hello  world\n", "<|endoftext|>a<|endoftext|>", "é字🎉\x00  x", "the cat " * 9000, "a" * 5000, "\r\n\t '' 's"]


def library_ids(text, end):
    return [*Tokenizer.from_file(BPE).encode(text or "", add_special_tokens=False).ids, end]


def test_ids_are_the_librarys():
    library, encode, dice = Tokenizer.from_file(BPE), tokens.encoder(BPE), random.Random(1)
    odd = [10, 13, 9, 32, 32, 39, 0x85, 0xA0, 0x1C, 0x2028, 0x3000, 0x200B]
    for _ in range(5000):
        text = "".join(
            chr(dice.choice([dice.randrange(32, 127), dice.randrange(1, 0x3000), dice.randrange(0x10000, 0x1FFFF), dice.choice(odd)]))
            for _ in range(dice.randrange(1, 24))
        )
        assert encode(text) == library.encode(text, add_special_tokens=False).ids
    for text in TEXTS[1:]:
        assert encode(text) == library.encode(text, add_special_tokens=False).ids
        assert tokens.encoder(BPE, "tokenizers")(text) == encode(text)


@pytest.mark.parametrize("white", [" ", "\n", " \n\t", "\u3000"])
def test_long_white_space_inside_a_text(white):
    library, encode = Tokenizer.from_file(BPE), tokens.encoder(BPE)
    for n in (500_000, 3_000_000):
        for text in ("a word" + white * (n // len(white)) + "b <|endoftext|> c", "a" * 7 + white * (n // len(white))):
            assert encode(text) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("max_bits", [8, 12, 20])
def test_code_lengths_are_limited_and_optimal(max_bits):
    counts = (1e6 / np.arange(1, 201) ** 2).astype(int) + 1
    lengths = code_lengths(counts, max_bits)
    assert lengths.max() <= max_bits and np.isclose((2.0 ** -lengths.astype(float)).sum(), 1)
    if max_bits == 20:  # Huffman's own sum of merged weights, where the limit doesn't bind
        import heapq

        heap, cost = counts.tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            merged = heapq.heappop(heap) + heapq.heappop(heap)
            cost += merged
            heapq.heappush(heap, merged)
        assert int((lengths * counts).sum()) == cost


def test_code_lengths_of_few_symbols():
    assert code_lengths(np.zeros(5, int)).tolist() == [0] * 5
    assert code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        code_lengths(np.ones(9, int), 3)


def test_round_trip_of_blocks_and_checkpoints():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 1000, 3000) ** 3
    book = Codebook(code_lengths(counts, 16))
    used = np.flatnonzero(counts)
    sizes = np.array([0, 1, EVERY, EVERY + 1, 0, BLOCK, BLOCK + 1, 3 * BLOCK + 5, 0, 77])
    ids = rng.choice(used, sizes.sum())
    payloads, offsets = book.encode(ids, sizes, BLOCK, EVERY)
    assert (book.decode(payloads, offsets, sizes, EVERY) == ids).all()
    assert all((o[:: BLOCK // EVERY] % 8 == 0).all() for o in offsets)  # blocks begin on bytes
    begin = int(sizes[:7].sum())  # reading on from one checkpoint alone
    alone = book.decode([payloads[7]], [offsets[7][5:6]], np.array([EVERY]), EVERY)
    assert (alone == ids[begin + 5 * EVERY : begin + 6 * EVERY]).all()


def test_token_files_round_trip(spark, tmp_path):
    rows = list(enumerate(TEXTS)) + [(3, "again"), (None, "no key")]
    dice = random.Random(1)
    dice.shuffle(rows)
    docs = with_clashing_columns(documents(spark, rows).repartition(3))
    write_token_files(docs, f"{tmp_path}/f", BPE, end=0)
    found = sorted((r for r in read_token_files(spark, f"{tmp_path}/f").collect()), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [None, 0, 1, 2, 3, 3, 4, 5, 6, 7]
    start, texts = 0, {i: t for i, t in enumerate(TEXTS)}
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert r["start"] == start and r["n_tokens"] == len(ids)
        start += len(ids)
        if r["doc_id"] not in (None, 3):
            assert ids == library_ids(texts[r["doc_id"]], 0)
    assert {tuple(np.frombuffer(r["ids"], "<u4").tolist()) for r in found if r["doc_id"] == 3} == {tuple(library_ids(t, 0)) for t in (TEXTS[3], "again")}
    sums = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in read_checksums(spark, f"{tmp_path}/f").collect()}
    assert sums == {(r["doc_id"], r["start"]): zlib.crc32(r["ids"]) for r in found}
    assert read_codebook(spark, f"{tmp_path}/f").max() <= 20


def test_token_files_of_an_empty_table(spark, tmp_path):
    write_token_files(documents(spark, []), f"{tmp_path}/f", BPE)
    assert read_checksums(spark, f"{tmp_path}/f").collect() == []


def test_an_item_goes_where_the_squares_grow_least():
    dice, size = random.Random(6), 12
    packer = SumOfSquares(size)
    for _ in range(3000):
        s = dice.randint(1, size)
        before = packer.counts.copy()
        costs = {}
        for level in range(size - s + 1):
            if level and not before[level]:
                continue
            after = before.copy()
            after[level] -= level > 0
            if level + s < size:
                after[level + s] += 1
            costs[level] = int((after**2).sum())
        packer.place(("d", 0, np.zeros(s), s), s)
        assert int((packer.counts**2).sum()) == min(costs.values())
        assert packer.counts[0] == 0 and [len(w) for w in packer.open] == packer.counts.tolist()


def check_packing(rows, pieces, size, end):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for group in by_sequence.values():
        at = 0
        for p in sorted(group, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at == size or at & (at - 1) == 0 and at < size
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for key, text in rows:
        ids = library_ids(text, end)
        own, at = sorted(by_doc[key, len(ids)], key=lambda p: p["start"]), 0
        for p in own:
            assert p["start"] == at
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)


def test_packing_holds_every_id_once(spark):
    dice = random.Random(8)
    rows = list(enumerate(TEXTS)) + [(100 + i, " ".join(dice.choices(["the", "cat", "é", "xyzzy"], k=dice.randint(0, 400)))) for i in range(120)]
    rows.append((None, "a text without a key"))
    docs = with_clashing_columns(documents(spark, rows).repartition(2))
    for size in (2048, 64):
        check_packing(rows, pack_documents(docs, BPE, size=size, end=1).collect(), size, 1)


def test_packing_of_repeated_rows_and_of_an_empty_table(spark):
    pieces = pack_documents(documents(spark, [(1, "a b"), (1, "a b")]).coalesce(1), BPE, size=64).collect()
    assert [(p["doc_id"], p["start"], p["length"], p["sequence_id"]) for p in pieces][0] == (1, 0, 3, 0) and sum(p["length"] for p in pieces) == 6
    assert pack_documents(documents(spark, []), BPE).collect() == []
