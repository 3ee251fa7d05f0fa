from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, with_clashing_columns

from tallyforge.llm import piece_nbest as P
from tallyforge.llm.shingles import KEPT, Shingler

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return P.Pieces(MODEL)


def all_paths(pieces, text):
    body = P.SPACE + text.replace(" ", P.SPACE)
    lattice, out = pieces.lattice(body), []

    def go(i, score):
        if i == len(body):
            out.append(score)
        else:
            for j, s, _ in lattice[i]:
                go(j, score + s)

    go(0, 0.0)
    return sorted(out, reverse=True)


def test_n_best_against_all_paths(pieces):
    dice = random.Random(2)
    for _ in range(250):
        text = "".join(dice.choice("the andé\n字x  🎉") for _ in range(dice.randrange(1, 12)))
        for n in (1, 4, 9):
            found = pieces.n_best(text, n, {})
            assert np.allclose([s for _, s in found], all_paths(pieces, text)[:n])
            assert len({i for i, _ in found}) == len(found)
            assert all(pieces.decode(np.frombuffer(i, "<u4")) == text for i, _ in found)


def test_many_at_once_are_solved_like_one(pieces):
    dice = random.Random(3)
    words = [P.SPACE + "".join(dice.choices("abcdethionrsé字", k=9)) for _ in range(500)]
    for word, (ids, score, gap) in zip(words, pieces.best_of_many(words)):
        one = pieces.best(word)
        assert ids == one[0] and np.isclose(score, one[1]) and np.isclose(gap, one[2])
        search = pieces.paths(word, 2)
        assert search[0][0] == ids and np.isclose(search[0][1] - search[1][1], gap)


def test_rows(spark):
    texts = [(1, "Hello world, hello lattice"), (2, None), (3, ""), (4, "a"), (5, " double  blanks \n"), (6, "字🎉\x00"), (1, "Hello world, hello lattice"), (None, "x"), (7, "word " * 50_000), (8, "w" * 3000)]
    docs = with_clashing_columns(documents(spark, texts))
    rows = P.summary(docs, MODEL, n=4).collect()
    assert len(rows) == len(texts) and all(r["round_trip"] for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["n_pieces"] == by_id[3]["n_pieces"] == 0 and by_id[3]["n_found"] == 1 and by_id[1]["n_found"] == 4
    ranked = P.segment(docs.filter("doc_id = 5"), MODEL, n=4).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3, 4]
    assert np.allclose([r["score"] for r in ranked], all_paths(P.pieces_of(MODEL), " double  blanks \n")[:4])
    assert P.summary(documents(spark, []), MODEL).collect() == []


def test_long_stretches_are_not_kept(pieces):
    """Texts without blanks, one stretch each: what a task keeps has a bound in bytes."""
    dice, seen = random.Random(8), {}
    texts = ["".join(dice.choices("abcdefgh", k=dice.randint(10, 3_000))) for _ in range(60)]
    found = pieces.n_best_of([*texts, texts[0], "", "of the"], 4, seen)
    assert [f[0] for f in found] == [pieces.n_best(t, 4, {})[0] for t in [*texts, texts[0], "", "of the"]]
    assert seen and max(map(len, seen)) <= P.KEPT and all(len(t) <= P.KEPT for t, _ in pieces.searched)


def test_long_words_are_not_kept():
    shingler = Shingler(1)
    text = " ".join("x" * k for k in range(1, 500))
    first = shingler(text)
    assert (shingler(text) == first).all() and len(first) == 499
    assert max(map(len, shingler.words)) == KEPT
