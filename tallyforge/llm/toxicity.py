"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.vector_sums import vector_sums

BITS = 18  # n-grams fall into 2 ** BITS buckets
SIZES = (4, 5, 6, 7)  # characters of an n-gram, blanks at word edges included
CHUNK = 1 << 21  # characters hashed in one numpy pass


@dataclass
class Model:
    """weights: of every bucket, 0 for those left out; intercept: of the log-odds."""

    weights: np.ndarray
    intercept: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1; each n-gram counts once a text, however often it occurs."""
        used = self.weights != 0
        logits = np.full(len(texts), self.intercept)
        for i, buckets in buckets_of(texts, used):
            logits[i] += self.weights[buckets].sum()
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _letters(text: str | None) -> np.ndarray:
    """Lower-cased code points between blanks; runs of anything but letters and digits are one blank."""
    codes = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    blank = (codes < 128) & ~_WORD[np.minimum(codes, 127)]
    keep = np.append(True, ~(blank[1:] & blank[:-1]))
    return np.where(blank, 32, codes)[keep].astype(np.uint64)


_WORD = np.array([chr(c).isalnum() for c in range(128)])


def _grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the sizes in SIZES that are not broken by a blank in the middle."""
    blank = codes == 32
    rolling = codes * np.uint64(0x9E3779B97F4A7C15)
    inner = np.zeros(len(codes), dtype=np.int32)
    np.cumsum(blank, out=inner)
    for n in range(2, SIZES[-1] + 1):
        if len(codes) < n:
            return
        rolling = (rolling[:-1] ^ (rolling[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + codes[n - 1 :]
        if n in SIZES:
            mixed = (rolling ^ (rolling >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
            whole = inner[n - 2 :][: len(rolling)] == inner[: len(rolling)]  # no blank at positions 1 .. n - 2
            yield (mixed >> np.uint64(64 - BITS))[whole].astype(np.int64)


def buckets_of(texts: list[str | None], used: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(position, distinct buckets) of each text; only buckets in `used`, if given."""
    first = np.zeros(1 << BITS, dtype=np.int64)
    for i, text in enumerate(texts):
        parts = []
        codes = _letters(text)
        for at in range(0, max(len(codes), 1), CHUNK):  # a long text in passes that overlap by an n-gram
            for grams in _grams(codes[at : at + CHUNK + SIZES[-1] - 1]):
                parts.append(grams if used is None else grams[used[grams]])
        found = np.concatenate(parts) if parts else np.empty(0, np.int64)
        first[found] = np.arange(len(found))
        yield i, found[first[found] == np.arange(len(found))]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = 4000,
    features: int = 2000,
    smoothing: float = 1.0,
    penalty: float = 1e-3,
    rounds: int = 200,
) -> Model:
    """Fit on a bounded sample: the `sample` labelled rows of each class with the smallest key hash.

    Document counts of every bucket in both classes give r = log ratio of the smoothed
    rates.  The `features` buckets stay whose rate is higher among label 1 by most units of
    the difference's spread (what is merely usual in clean text says nothing about a text
    that lacks it, an empty one above all); a feature is r where the n-gram occurs, and a
    logistic regression with an L2 penalty weights them.  The intercept is moved to the share of label 1 among all
    labelled rows.  The sample's keys (at most 2 * sample) are broadcast; its n-grams are
    counted in the tasks, and only fixed-size counts and the chosen features of the sample
    reach the driver.  Rows with a null label or key don't count; with one class alone, or
    no row, every score is its smoothed share.
    """
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).dropna()
    classes = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    share = np.log((classes.get(1, 0) + 0.5) / (classes.get(0, 0) + 0.5))
    weights = np.zeros(1 << BITS)
    if not (classes.get(0) and classes.get(1)):
        return Model(weights, float(share))
    picked = None
    for c in (0, 1):
        part = known.filter(F.col("_label") == c).orderBy(F.xxhash64("_key"), "_key").limit(sample)
        picked = part if picked is None else picked.union(part)
    rows = picked.collect()  # at most 2 * sample
    picked = docs.sparkSession.createDataFrame(rows, picked.schema)
    chosen = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(picked), "_key")
    chosen = chosen.select("_label", "_text")

    def count(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        """Of each class the texts that hold each bucket, and in the last place their number."""
        counts = {}
        for batch in batches:
            marks = batch.column(0).to_pylist()
            for i, found in buckets_of(batch.column(1).to_pylist()):
                of_class = counts.setdefault(marks[i], np.zeros((1 << BITS) + 1, dtype=np.int64))
                of_class[found] += 1
                of_class[-1] += 1
        return counts

    sums = vector_sums(chosen, count)
    both = np.array([sums.get(c, np.zeros((1 << BITS) + 1)) for c in (0, 1)], dtype=np.float64)
    counts, n = both[:, :-1], both[:, -1]
    if not n.all():
        return Model(weights, float(share))
    rates = (counts + smoothing) / (n[:, None] + 2 * smoothing)
    ratio = np.log(rates[1] / rates[0])
    spread = np.sqrt((rates * (1 - rates) / n[:, None]).sum(axis=0))
    signal = np.where(counts.sum(axis=0) >= 3, (rates[1] - rates[0]) / spread, 0)
    kept = np.sort(np.argsort(-signal, kind="stable")[:features])
    kept = kept[signal[kept] > 0]
    used = np.zeros(1 << BITS, dtype=bool)
    used[kept] = True

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [b.astype("<u4").tobytes() for _, b in buckets_of(batch.column(1).to_pylist(), used)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.binary())], ["label", "found"])

    described = chosen.mapInArrow(describe, "label int, found binary").collect()  # chosen features of the sample
    y = np.array([r["label"] for r in described], dtype=np.float64)
    found = [np.frombuffer(r["found"], "<u4") for r in described]
    row_of = np.repeat(np.arange(len(found)), [len(f) for f in found])
    column = np.searchsorted(kept, np.concatenate(found))
    v, b = _logistic(row_of, column, ratio[kept], y, penalty, rounds)
    weights[kept] = v * ratio[kept]
    return Model(weights, float(b + share - np.log(n[1] / n[0])))


def _logistic(row_of, column, scale, y, penalty: float, rounds: int) -> tuple[np.ndarray, float]:
    """Nesterov's gradient method on the mean log loss of sparse rows whose entries are scale[column].

    Every weight has its own step, from a diagonal bound of the curvature, so rare n-grams
    move as fast as frequent ones.
    """
    n, width = len(y), len(scale)
    entries = scale[column]
    size = np.bincount(row_of, np.abs(entries), n) + 1
    step = 1 / (np.bincount(column, np.abs(entries) * size[row_of], width) / (4 * n) + penalty)
    b_step = 4 * n / size.sum()
    v, b = np.zeros(width), 0.0
    ahead, b_ahead, t = v, b, 1.0
    for _ in range(rounds):
        z = np.bincount(row_of, ahead[column] * entries, n) + b_ahead
        error = (1 / (1 + np.exp(-z)) - y) / n
        new = ahead - step * (np.bincount(column, error[row_of] * entries, width) + penalty * ahead)
        new_b = b_ahead - b_step * error.sum()
        faster = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, b_ahead = new + (t - 1) / faster * (new - v), new_b + (t - 1) / faster * (new_b - b)
        v, b, t = new, new_b, faster
    return v, b


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score (0 to 1) of every row, from its whole text and nothing else.

    Null and empty texts get the score of the intercept.  Null keys and repeated rows are
    scored like any row.  Other columns are not read.  An empty table gives an empty one.
    """
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch(
                [batch.column(0), pa.array(shared.value.scores(batch.column(1).to_pylist()))], [key, "score"]
            )

    return source.mapInArrow(rate, f"`{key}` {source.schema['_key'].dataType.simpleString()}, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The rows of docs whose text scores below threshold, with all their columns."""
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.scores(batch.column(at).to_pylist()) < threshold))

    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    return plain.mapInArrow(judge, plain.schema).toDF(*docs.columns)


def held_out(key: Column) -> Column:
    """Rows whose labels are not learned from: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
