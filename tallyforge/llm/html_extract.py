"""Main text of web pages: a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.html_blocks import Block, leaf_blocks

CACHED = 20000  # paths whose features a task remembers


def path_features(path: tuple[str, ...]) -> list[str]:
    """Every ancestor's tag and names, the names of the nearest two, their tags, and the depth."""
    path = tuple(e for e in path if e.split(" ", 1)[0] not in ("html", "body"))  # often left out
    out = {"any", *(f"tag {e.split(' ', 1)[0]}" for e in path)}
    for e in path:
        out.update(f"name {w}" for w in e.split(" ")[1:])
    for e in path[-2:]:
        out.update(f"own {w}" for w in e.split(" ")[1:])
    near = [e.split(" ", 1)[0] for e in path[-2:]]
    out.update([f"in {'/'.join(near[-1:])}", f"in {'/'.join(near)}", f"depth {min(len(path), 12)}"])
    return sorted(out)


def text_features(block: Block, nth: int, of: int) -> list[str]:
    """Length, links, punctuation, case, digits, place in the page, and the words of short blocks."""
    text = block.text
    n_words = text.count(" ") + 1
    out = [
        f"words {n_words.bit_length()}",
        f"links {round(4 * min(1.0, block.linked / len(text)))}",
        f"last {text[-1] if not text[-1].isalnum() else 'x'}",
        f"commas {min(text.count(','), 3)}",
        f"place {4 * nth // max(of, 1)}",
        f"upper {text.isupper()}",
    ]
    if "©" in text:
        out.append("copyright")
    if n_words <= 12 and any(c.isdigit() for c in text):
        out.append("short with digits")
    return out


@dataclass
class Crf:
    """Two labels, 1 for main text.  weights: score of label 1 for each feature; edges[a, b]: of a before b; first: of label 1 at the start."""

    features: dict[str, int]
    weights: np.ndarray
    edges: np.ndarray
    first: float

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Viterbi: the likeliest labels of a page whose blocks score `scores` for label 1."""
        n = len(scores)
        back = np.zeros((n, 2), dtype=np.int8)
        best = (0.0, float(scores[0]) + self.first) if n else (0.0, 0.0)
        (e00, e01), (e10, e11) = self.edges.tolist()
        for t, s in enumerate(scores[1:].tolist(), 1):
            keep, change = best[0] + e00, best[1] + e10
            up, stay = best[0] + e01, best[1] + e11
            back[t] = change > keep, stay > up
            best = (max(keep, change), max(up, stay) + s)
        labels = np.zeros(n, dtype=np.int8)
        label = int(best[1] > best[0])
        for t in range(n - 1, -1, -1):
            labels[t] = label
            label = back[t, label]
        return labels

    def main_text(self, page: str | None, seen: dict) -> str:
        blocks = leaf_blocks(page)
        scores = np.zeros(len(blocks))
        for i, block in enumerate(blocks):
            if (of_path := seen.get(block.path)) is None:
                of_path = sum(self.weights[k] for f in path_features(block.path) if (k := self.features.get(f)) is not None)
                if len(seen) < CACHED:
                    seen[block.path] = of_path
            scores[i] = of_path + sum(
                self.weights[k] for f in text_features(block, i, len(blocks)) if (k := self.features.get(f)) is not None
            )
        return "\n".join(b.text for b, y in zip(blocks, self.decode(scores)) if y) if blocks else ""


def train(pages: list[tuple[list[Block], list[int]]], penalty: float = 0.005, rounds: int = 200) -> Crf:
    """Maximum conditional likelihood with an L2 penalty, on labelled pages.

    All pages run through forward and backward together, one block after the other; the
    gradient is expected minus observed, and every weight has its own step (Adagrad).
    """
    features: dict[str, int] = {}
    rows = [
        [[features.setdefault(f, len(features)) for f in path_features(b.path) + text_features(b, i, len(blocks))] for i, b in enumerate(blocks)]
        for blocks, _ in pages
    ]
    sizes = np.array([len(r) for r in rows])
    longest, n = int(sizes.max(initial=0)), len(pages)
    real = np.arange(longest) < sizes[:, None]
    y = np.zeros((n, longest), dtype=int)
    for i, (_, labels) in enumerate(pages):
        y[i, : len(labels)] = labels
    flat = [f for r in rows for f in r]
    block_of = np.repeat(np.arange(len(flat)), [len(f) for f in flat])
    column = np.array([k for f in flat for k in f], dtype=int)
    observed_edges = np.zeros((2, 2))
    pair = real[:, 1:]
    np.add.at(observed_edges, (y[:, :-1][pair], y[:, 1:][pair]), 1)
    theta = np.zeros(len(features) + 5)  # weights, edges, first
    squares = np.full(len(theta), 1e-8)
    for _ in range(rounds):
        weights, edges, first = theta[:-5], theta[-5:-1].reshape(2, 2), theta[-1]
        scores = np.zeros((n, longest))
        scores[real] = np.bincount(block_of, weights[column], len(flat))
        emit = np.stack([np.zeros_like(scores), scores], axis=2)
        ahead = np.zeros((n, longest, 2))
        ahead[:, 0] = emit[:, 0] + [0, first]
        for t in range(1, longest):
            ahead[:, t] = np.logaddexp(*(ahead[:, t - 1, a, None] + edges[a] for a in (0, 1))) + emit[:, t]
        behind = np.zeros((n, longest, 2))
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp(*(edges[:, b] + (emit[:, t + 1, b] + behind[:, t + 1, b])[:, None] for b in (0, 1)))
            behind[:, t] = np.where(real[:, t + 1, None], step, 0)
        both = ahead + behind
        total = np.logaddexp(both[:, 0, 0], both[:, 0, 1])
        expected = np.where(real, np.exp(both[:, :, 1] - total[:, None]), 0)
        gradient = np.zeros(len(theta))
        gradient[:-5] = np.bincount(column, (expected - y)[real][block_of], len(features))
        for a in (0, 1):
            for b in (0, 1):
                log = ahead[:, :-1, a] + edges[a, b] + emit[:, 1:, b] + behind[:, 1:, b] - total[:, None]
                gradient[len(features) + 2 * a + b] = np.exp(log[pair]).sum() - observed_edges[a, b]
        gradient[-1] = (expected[:, 0] - y[:, 0])[sizes > 0].sum()
        gradient = gradient / max(n, 1) + penalty / max(n, 1) * theta
        squares += gradient**2
        theta = theta - 0.3 * gradient / np.sqrt(squares)
    return Crf(features, theta[:-5], theta[-5:-1].reshape(2, 2), float(theta[-1]))


# Names that layouts give to the parts of a page.
MAIN = ["article", "main", "div class=content", "div class='post body'", "div id=main-content", "section class=entry", "div class=article-text", "div class=story"]
LINKS = ["nav", "div class=menu", "div class='nav bar'", "ul class=breadcrumb", "header", "div class='top header'", "div id=masthead", "div class='share social'", "div class='tags related'"]
SIDE = ["aside", "div class=sidebar", "div class='widget related'", "aside class='promo box'", "div id=side"]
SHORT = ["div class=ad", "div class='advert banner'", "div class=sponsored", "ins class=ads", "div class='cookie notice'", "div class='alert notice'", "div class=notice", "div class='popup newsletter'", "div role=dialog", "div class=consent", "div role=alert"]
FOOT = ["footer", "div class=footer", "div id='site-footer legal'"]
REPLIES = ["section class=comments", "div id=comments", "ol class='comment list'", "div class='reply thread'", "div class='user discussion'", "div class=responses"]


def labelled_layouts(parts: list[tuple[list[str], list[str]]], seed: int = 1) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages: main paragraphs and other texts of real pages, laid out anew.

    parts: (main blocks, other blocks) of pages.  Every page is laid out three ways under
    names drawn from the lists above, with menus, headers, footers, sidebars, notices,
    adverts, forms and readers' comments; comments get the paragraphs of another page, so
    that not the words but the place decides.  Labels follow from the layout.
    """
    dice, out = random.Random(seed), []
    for k, (main, other) in enumerate(parts):
        if not main:
            continue
        foreign = [t for t in parts[(k + 7) % len(parts)][0] if t not in main] or ["Thanks for this."]
        words = [w for t in other for w in t.split()] or ["Home", "About"]
        for _ in range(3):
            laid: list[tuple[str, int]] = []  # html, label of the texts in it
            bare = dice.random() < 0.1  # a page of main text alone

            def put(names, body, label=0, chance=0.5):
                if dice.random() < chance and not bare:
                    wrap = dice.choice(names)
                    laid.append((f"<{wrap}>{body}</{wrap.split()[0]}>", label))

            def links():
                n = dice.randint(2, 7)
                items = "".join(f'<li><a href="/x">{_safe(dice.choice(words))}</a></li>' for _ in range(n))
                return f"<ul>{items}</ul>" if dice.random() < 0.7 else items.replace("li>", "span>")

            def prose(source, n):
                return [f"<p>{_safe(t)}</p>" for t in dice.sample(source, min(n, len(source)))]

            def side():
                return f"<h3>{_safe(' '.join(dice.sample(words, min(2, len(words)))))}</h3>" + dice.choice([links(), *prose(foreign, 1)])

            put(["header", "div class=header", "div id=top"], f"<h2>{_safe(' '.join(words[:3]))}</h2>" + links())
            put(LINKS, links(), chance=0.8)
            for _ in range(dice.randint(0, 2)):
                put(SHORT, dice.choice(prose(other or foreign, 1) + prose(foreign, 1)))
            put(SIDE, side(), chance=0.3)
            wrap = dice.choice(MAIN) if dice.random() < 0.85 else ""
            heading = f"<h1>{_safe(main[0])}</h1>" if dice.random() < 0.8 else ""
            body: list[tuple[str, int]] = [(heading, 1)]
            for text in main[1:] or main:
                tag = dice.choices(["p", "h2", "li", "div", "blockquote"], [20, 1, 1, 2, 1])[0]
                body.append((f"<{tag}>{_safe(text)}</{tag}>", 1))
                if dice.random() < 0.12:
                    inner = dice.choice(SHORT + SIDE)
                    body.append((f"<{inner}>{dice.choice(prose(foreign, 1))}</{inner.split()[0]}>", 0))
            replies = []
            if dice.random() < 0.4 and not bare:
                inner = dice.choice(REPLIES)
                said = "".join(f"<div class='{dice.choice(['comment', 'reply', 'item'])}'>{p}</div>" for p in prose(foreign, 4))
                replies = [(f"<{inner}><h3>{_safe(words[0])}</h3>{said}</{inner.split()[0]}>", 0)]
            inside = dice.random() < 0.4
            if not wrap:  # main text that nothing holds together
                laid += [*body, *([] if bare else replies)]
            else:
                laid += [(f"<{wrap}>", 0), *body, *(replies if inside else []), (f"</{wrap.split()[0]}>", 0)]
                laid += [] if inside or bare else replies
            put(["form", "form class=login", "div class='search form'"], f"<label>{_safe(words[0])}</label><input><button>{_safe(words[-1])}</button>", chance=0.4)
            put(SIDE, side(), chance=0.4)
            put(SHORT, "".join(prose(other or foreign, 1)), chance=0.3)
            put(FOOT, f"&copy; {_safe(' '.join(words[:6]))}" + (links() if dice.random() < 0.4 else ""), chance=0.9)
            # a mark before each part tells the labels of its blocks apart; it is taken out again
            html = "<html><body>" + "".join(f"{h[: h.find('>') + 1]}\x01{h[h.find('>') + 1 :]}" if y else h for h, y in laid) + "</body></html>"
            blocks = leaf_blocks(html)
            labels = [int("\x01" in b.text) for b in blocks]
            cleaned = [(b._replace(text=b.text.replace("\x01", "").strip()), y) for b, y in zip(blocks, labels)]
            cleaned = [(b, y) for b, y in cleaned if b.text]
            out.append(([b for b, _ in cleaned], [y for _, y in cleaned]))
    return out


def _safe(text: str) -> str:
    return re.sub(r"[<>&\x01]", " ", text)


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = 200, longest: int = 50_000) -> Crf:
    """A model from whole pages: of those of at most `longest` bytes, the `sample` with the smallest hash of their key.

    Both bounds are on what reaches the driver (10 MB by default) and on nothing else;
    extraction takes every page.

    Pages that mark their text with an article element label themselves: its blocks are
    main text, blocks outside are not.  They are learned from as they are, and laid out
    anew (labelled_layouts), so that the model doesn't hang on one element.  Where no page
    of the sample has an article, the fixed sentences of LAST_RESORT are laid out.
    """
    present, order = pages.filter(F.octet_length(html) <= longest), F.xxhash64(key)
    last = present.select(order.alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]  # hashes, not pages
    rows = present.filter(order <= F.lit(last)).orderBy(order, key).select(F.col(html).alias("html")) if last is not None else present
    labelled, parts = [], []
    for row in rows.limit(sample).collect():  # at most `sample` pages of `longest` bytes
        blocks = leaf_blocks(row["html"])
        labels = [int(any(e.split(" ")[0] == "article" for e in b.path)) for b in blocks]
        if any(labels):
            labelled.append((blocks, labels))
            parts.append(([b.text for b, y in zip(blocks, labels) if y], [b.text for b, y in zip(blocks, labels) if not y]))
    return train(labelled + labelled_layouts(parts or LAST_RESORT))


LAST_RESORT = [
    (["A walk by the river", "We left the town early, and the road was empty.", "By noon, the rain had stopped and the hills were green."], ["Home", "About us", "Contact"]),
    (["Notes on bread", "Flour, water and salt are enough, if there is time.", "The dough rests overnight, then it is folded and baked."], ["News", "Sport", "Sign in"]),
] * 20


def extract(pages: DataFrame, model: Crf, key: str = "page_id", html: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """key, the columns in keep, text (blocks of main text joined by line ends) and n_chars.

    Null and empty pages, and pages without text, give an empty text.  Null keys and
    repeated rows are handled like any row; an empty table gives an empty one.
    """
    source = pages.select(key, *keep, F.col(html).alias("_html"))
    shared = pages.sparkSession.sparkContext.broadcast(model)  # as many weights as the sample has features

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf, seen = shared.value, {}
        for batch in batches:
            texts = [crf.main_text(page, seen) for page in batch.column(len(keep) + 1).to_pylist()]
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [key, *keep, "text", "n_chars"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return source.mapInArrow(read, ", ".join([*fields, "text string", "n_chars long"]))
