from __future__ import annotations

import numpy as np
import pytest

from tallyforge.llm import toxicity as T
from tallyforge.llm.vector_sums import PIECE, vector_sums


@pytest.fixture
def tally():
    def sums_of(batches):
        sums = {}
        for batch in batches:
            for i in batch.column(0).to_pylist():
                vector = sums.setdefault(i % 2, np.zeros(2 * PIECE + 7 + i % 2, np.int64))
                vector[i % len(vector)] += i
        return sums

    return sums_of


def test_sums_of_all_tasks(spark, tally):
    found = vector_sums(spark.range(0, 100_000, 1, 13), tally)
    assert set(found) == {0, 1}
    for name, vector in found.items():
        ids = np.arange(name, 100_000, 2)
        want = np.bincount(ids % (2 * PIECE + 7 + name), ids, 2 * PIECE + 7 + name)
        assert vector.tolist() == want.astype(np.int64).tolist()
    assert vector_sums(spark.range(0), tally) == {}


def jobs(spark, work, tag):
    spark.sparkContext.setJobGroup(tag, tag)
    work()
    spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))


def test_as_many_jobs_for_any_number_of_splits(spark, tally):
    few = jobs(spark, lambda: vector_sums(spark.range(0, 1000, 1, 4), tally), "four splits")
    many = jobs(spark, lambda: vector_sums(spark.range(0, 1000, 1, 40), tally), "forty splits")
    assert few == many


def test_ratios_and_scores_against_brute_force(spark):
    """Weights are those of a logistic regression over ratios counted one text at a time."""
    texts = [f"{'idiotic scumbag' if i % 3 == 0 else 'quiet river'} number {i % 7} of the day" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    model = T.fit(docs, labels)
    held = np.zeros((2, 1 << T.BITS))
    for i, found in T.buckets_of(texts):
        held[int(i % 3 == 0), found] += 1
    n = np.array([40, 20])
    rates = (held + 1) / (n[:, None] + 2)
    ratio = np.log(rates[1] / rates[0])
    spread = np.sqrt((rates * (1 - rates) / n[:, None]).sum(axis=0))
    signal = np.where(held.sum(axis=0) >= 3, (rates[1] - rates[0]) / spread, 0)
    kept = np.sort(np.argsort(-signal, kind="stable")[:2000])
    kept = kept[signal[kept] > 0]
    assert set(np.flatnonzero(model.weights)) <= set(kept)
    rows, columns = zip(*((i, c) for i, found in T.buckets_of(texts) for c in np.intersect1d(found, kept)))
    x = np.zeros((60, len(kept)))
    x[list(rows), np.searchsorted(kept, columns)] = ratio[kept][np.searchsorted(kept, columns)]
    z = x @ (model.weights[kept] / ratio[kept])
    scores = np.asarray(model.scores(texts))
    logits = np.log(scores / (1 - scores))
    assert np.allclose(logits - z, (logits - z)[0], atol=1e-6)
    assert scores[::3].min() > 0.5 > np.delete(scores, np.s_[::3]).max()
