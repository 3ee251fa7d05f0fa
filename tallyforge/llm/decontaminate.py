"""Benchmark decontamination: windows of test words looked up in the windows of all training words.

DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.scratch import store

WINDOW = 10  # words
BROADCAST = 1 << 20  # distinct windows; some 200 bytes each, so 200 MB at most
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # between words
WORD = GAP.replace("[", "[^")


def _words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, GAP, -1), "")


def _windows_of(rows: DataFrame, sizes: list[int], summary: bool = False) -> DataFrame:
    """The columns of rows, with `_size, _at, _hash, _gram` of every window of `_words`; `_at` counts words from 0.

    With `summary` every row also gives one line of `_at` -1, `_size` its number of words
    and the hash 0.  Only plain functions: generated code makes and looks up window after
    window without keeping them.
    """
    n, first = F.size("_words"), F.lit(sizes[0] if summary else 0)
    sized = rows.withColumn("_size", F.explode(F.array(*map(F.lit, sizes)))).filter((n >= F.col("_size")) | (F.col("_size") == first))
    start = F.when(F.col("_size") == first, -1).otherwise(0)
    placed = sized.withColumn("_at", F.explode(F.sequence(start, F.greatest(n - F.col("_size"), start))))
    here = F.slice("_words", F.col("_at") + 1, F.col("_size"))
    real = F.col("_at") >= 0
    return placed.select(
        *rows.columns,
        F.when(real, F.col("_size")).otherwise(n).alias("_size"),
        "_at",
        F.when(real, F.xxhash64(here)).otherwise(F.lit(0).cast("long")).alias("_hash"),
        F.when(real, F.array_join(here, " ")).otherwise("").alias("_gram"),
    )


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(hash, gram, size, item): the windows of all items.

    Windows are `window` words long; an item of fewer, but not none, is one window.  Items
    with a null id or without words have none; rows that repeat an id are one item.
    """
    rows = benchmark.select(F.col(item).alias("_item"), _words(F.col(text)).alias("_words")).filter("_item IS NOT NULL")
    found = _windows_of(rows, list(range(1, window + 1)))
    own = (F.col("_size") == window) | (F.col("_size") == F.size("_words"))
    return found.filter(own).select(
        F.col("_hash").alias("hash"), F.col("_gram").alias("gram"), F.col("_size").alias("size"), F.col("_item").alias("item")
    ).distinct()


def occurrences(
    docs: DataFrame, windows: DataFrame, key: str = "doc_id", text: str = "text", broadcast: int = BROADCAST
) -> DataFrame:
    """(_key, _print, at, size, gram): every place of a document where a benchmark window stands, stored.

    Also one line for each row of docs, with `at` -1 and its number of words as size.  _print
    is the digest of the text: equal rows have the same places.  Up to `broadcast` distinct
    windows (counted first) are a broadcast hash set that the windows of the documents are
    looked up in as they are made, in one pass; more are joined by shuffle.  A hit of the hash
    is verified on the words themselves.
    """
    grams = windows.select("hash", "gram").distinct()
    by_size = windows.select("size", "gram").distinct().groupBy("size").count().collect()  # a row for each length
    sizes, total = sorted(r["size"] for r in by_size), sum(r["count"] for r in by_size)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), F.md5(body).alias("_print"), _words(F.col(text)).alias("_words"))
    wanted = ["_key", "_print", F.col("_at").alias("at"), F.col("_size").alias("size"), F.col("_gram").alias("gram")]
    # as a range, so that the words are not put together for every place as a second key of the join
    same = (F.col("_hash") == F.col("hash")) & F.col("gram").between(F.col("_gram"), F.col("_gram"))
    none = docs.sparkSession.createDataFrame([(0, "")], "hash long, gram string")
    if total <= broadcast:
        hits = _windows_of(rows, sizes or [WINDOW], summary=True).join(F.broadcast(grams.union(none)), same).select(*wanted)
    else:
        counts = rows.select("_key", "_print", F.lit(-1).alias("at"), F.size("_words").alias("size"), F.lit("").alias("gram"))
        hits = _windows_of(rows, sizes).drop("_words").join(grams, same).select(*wanted).union(counts)
    return store(hits, "leaks")[0]


def _merged(places: Column) -> Column:
    """Sorted (at, size) as the stretches (start, end) of words that they cover, end exclusive.

    One pass gathers for each place the stretch it begins, if it begins one.
    """
    none = F.expr("cast(array() AS array<struct<start:int,end:int>>)")
    ends = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"), none.alias("done"))

    def step(state: Column, place: Column) -> Column:
        end = place["at"] + place["size"]
        joins = place["at"] <= state["end"]
        closed = F.when(state["end"] < 0, state["done"]).otherwise(
            F.concat(state["done"], F.array(F.struct(state["start"].alias("start"), state["end"].alias("end"))))
        )
        return F.struct(
            F.when(joins, state["start"]).otherwise(place["at"]).alias("start"),
            F.when(joins, F.greatest(state["end"], end)).otherwise(end).alias("end"),
            F.when(joins, state["done"]).otherwise(closed).alias("done"),
        )

    last = lambda s: F.concat(s["done"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return F.aggregate(places, ends, step, last)


def _covered(places: Column) -> Column:
    """How many words sorted (at, size) cover."""

    def step(state: Column, place: Column) -> Column:
        end = place["at"] + place["size"]
        new = F.greatest(end - F.greatest(place["at"], state["end"]), F.lit(0))
        return F.struct((state["n"] + new).alias("n"), F.greatest(state["end"], end).alias("end"))

    return F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda s: s["n"])


def _places(hits: DataFrame) -> DataFrame:
    return hits.filter("at >= 0").groupBy("_key", "_print").agg(F.array_sort(F.collect_set(F.struct("at", "size"))).alias("places"))


def _wrapped(docs: DataFrame) -> DataFrame:
    """docs in one column `row`, so that no name clashes with those added."""
    return docs.select(F.struct(*docs.columns).alias("row"))


def _with(docs: DataFrame, found: DataFrame, key: Column, print_: Column) -> DataFrame:
    """docs, left-joined with rows by (_key, _print)."""
    return docs.join(found, key.eqNullSafe(F.col("_key")) & (print_ == F.col("_print")), "left")


def leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    window: int = WINDOW, broadcast: int = BROADCAST,
) -> DataFrame:
    """One row per row of docs: key, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of digits, a-z (A-Z in lower case) and characters above 127.  A word
    inside any occurrence of a benchmark window (benchmark_windows) is hit; n_items counts
    the items with an occurring window, items_sha256 is the digest of their ids, sorted as
    strings and comma-joined.  Null texts have no words.  Rows that repeat a key are rows
    of their own, null keys too; other columns are not read.  Without documents there are
    no rows, without benchmark items no hits.  Texts of any length are looked at whole.
    """
    windows, _ = store(benchmark_windows(benchmark, item, "text", window), "benchmark-windows")
    hits = occurrences(docs, windows, key, text, broadcast)
    covered = _places(hits).select("_key", "_print", _covered(F.col("places")).cast("long").alias("n_hit"))
    grams = hits.filter("at >= 0").select("_key", "_print", "gram").distinct()
    named = grams.join(windows.select("gram", F.col("item").cast("string").alias("item")), "gram")
    items = named.groupBy("_key", "_print").agg(F.array_sort(F.collect_set("item")).alias("items")).select(
        F.col("_key").alias("_k"), F.col("_print").alias("_p"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    )
    found = covered.join(items, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_print") == F.col("_p")))
    counted = hits.filter("at < 0").select(F.col("_key").alias("_id"), F.col("_print").alias("_of"), F.col("size").cast("long").alias("n_words"))
    zero = F.lit(0).cast("long")
    return _with(counted, found, F.col("_id"), F.col("_of")).select(
        F.col("_id").alias(key), "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def remove_documents(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    share: float = 0.0, window: int = WINDOW,
) -> DataFrame:
    """docs without the rows of which more than `share` of the words are hit; columns as they were."""
    windows, _ = store(benchmark_windows(benchmark, item, "text", window), "benchmark-windows")
    found = _places(occurrences(docs, windows, key, text)).select("_key", "_print", _covered(F.col("places")).alias("_hit"))
    n_words = F.regexp_count(F.coalesce(F.col("row")[text], F.lit("")), F.lit(WORD))
    stays = F.col("_hit").isNull() | (F.col("_hit") <= n_words * share)
    return _with(_wrapped(docs), found, F.col("row")[key], F.md5(F.coalesce(F.col("row")[text], F.lit("")))).filter(stays).select("row.*")


def remove_spans(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", window: int = WINDOW
) -> DataFrame:
    """docs whose texts have lost every hit word with what parts it from the word before; other columns stay."""
    windows, _ = store(benchmark_windows(benchmark, item, "text", window), "benchmark-windows")
    found = _places(occurrences(docs, windows, key, text)).select("_key", "_print", _merged(F.col("places")).alias("_cut"))
    # every piece is a word with the gap before it; the last holds the gap after the last word
    pieces = F.regexp_extract_all(F.col("row")[text], F.lit(f"{GAP[:-1]}*+(?:{WORD}|$)"), F.lit(0))
    with_start = F.concat(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))), F.col("_cut"))
    gaps = F.transform(
        with_start,
        lambda cut, i: F.array_join(
            F.slice("_pieces", cut["end"] + 1, F.coalesce(F.try_element_at("_cut", i + 1)["start"], F.size("_pieces")) - cut["end"]), ""
        ),
    )
    marked = _with(_wrapped(docs), found, F.col("row")[key], F.md5(F.coalesce(F.col("row")[text], F.lit(""))))
    marked = marked.withColumn("_pieces", F.when(F.col("_cut").isNotNull(), pieces))
    cleaned = F.when(F.col("_cut").isNotNull(), F.array_join(gaps, "")).otherwise(F.col("row")[text])
    return marked.select(*(cleaned.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))


def oracle(window: int = WINDOW) -> str:
    """The rows of leaks in DuckDB."""
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    return f"""
        WITH items AS (SELECT item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
        sized AS (SELECT item_id, w, least(len(w), {window}) AS size FROM items WHERE len(w) > 0),
        places AS (SELECT item_id, w, size, unnest(range(len(w) - size + 1)) AS pos FROM sized),
        grams AS (SELECT DISTINCT item_id, size, array_to_string(w[pos + 1:pos + size], ' ') AS gram FROM places),
        texts AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
        starts AS (
            SELECT r, w, size, unnest(range(len(w) - size + 1)) AS pos
            FROM texts, (SELECT DISTINCT size FROM grams) WHERE len(w) >= size
        ),
        hits AS (
            SELECT r, pos, s.size, item_id FROM starts s JOIN grams g
            ON g.size = s.size AND g.gram = array_to_string(s.w[pos + 1:pos + s.size], ' ')
        ),
        covered AS (
            SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(pos, pos + size)) AS word FROM hits) GROUP BY r
        ),
        named AS (
            SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
            FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM texts LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
    """
