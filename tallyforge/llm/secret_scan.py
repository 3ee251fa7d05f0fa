"""Secret scans: fixed patterns, and character Markov models of random strings against identifiers.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kind, pattern, group whose length counts, least length.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
KINDS = ("assign", "access", "hex", "random")  # in the order of equal starts
LETTERS = "[A-Za-z0-9+/_-]"  # of tokens that the models judge
IDENTIFIER = LETTERS + "{6,}"
SPAN = "struct<start:int,end:int,rank:int,value:string>"
MARKS = ("\x01", "\x02", "\x03")
BLOCK = 256  # items of an array that are gathered one by one
CHUNK = 1024  # characters of a text that are looked through for one place


def let(value: Column, use) -> Column:
    """use(value), where value is computed once however often use names it."""
    return F.transform(F.array(value), use)[0]


def blocks_of(items: Column) -> Column:
    """An array cut into arrays of BLOCK items; an empty one gives one empty block.  items is named twice."""
    last = F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * BLOCK + 1, F.lit(BLOCK)))


def running(items: Column, begin: Column, advance, emit, kind: str) -> Column:
    """emit(at, item) of every item, an array of kind, where at begins with begin and goes on as advance(at, item).

    The whole numbers at the beginnings of blocks are found first, then every block is
    gathered by itself, so an array of n items costs n * BLOCK + (n / BLOCK)^2 short copies.
    """

    def of_blocks(blocks: Column) -> Column:
        first = F.struct(begin.alias("at"), F.expr("cast(array() AS array<int>)").alias("all"))
        starts = F.aggregate(
            blocks,
            first,
            lambda s, block: F.struct(
                F.aggregate(block, s["at"], advance).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")
            ),
            lambda s: s["all"],
        )

        def gather(block: Column, at: Column) -> Column:
            none = F.struct(at.alias("at"), F.expr(f"cast(array() AS array<{kind}>)").alias("out"))
            return F.aggregate(
                block,
                none,
                lambda s, item: F.struct(
                    advance(s["at"], item).alias("at"), F.concat(s["out"], F.array(emit(s["at"], item))).alias("out")
                ),
                lambda s: s["out"],
            )

        return F.flatten(F.zip_with(blocks, starts, gather))

    return let(items, lambda bound: let(blocks_of(bound), of_blocks))


def matches(text: Column, pattern: str, rank: int, group: int = 0, least: int = 1) -> Column:
    """All leftmost non-overlapping matches as (start, end, rank, value), end exclusive, in code points.

    The matches are bracketed by control characters, the text is cut at these, and the
    running length of the cuts gives the places.  Control characters of the text itself
    are exchanged for one that no pattern accepts, so lengths stay.  Matches whose group
    is shorter than `least` are dropped after matching, so they still use up their text.
    """
    plain = F.translate(text, "".join(MARKS), "\x04\x04\x04")
    marked = F.regexp_replace(plain, F.lit(pattern), F.lit(f"{MARKS[0]}$0{MARKS[1]}${group}{MARKS[2]}"))

    def measured(piece: Column) -> Column:
        """Length of the match, its value, and the way from its start to the next one's."""
        return let(
            F.split(piece, f"[{MARKS[1]}{MARKS[2]}]", -1),
            lambda parts: F.struct(
                F.length(parts[0]).alias("size"), parts[1].alias("value"), (F.length(parts[0]) + F.length(parts[2])).alias("step")
            ),
        )

    def spans(pieces: Column) -> Column:
        rest = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
        return running(
            F.transform(rest, measured),
            F.length(F.element_at(pieces, 1)),
            lambda at, m: at + m["step"],
            lambda at, m: F.struct(at.alias("start"), (at + m["size"]).alias("end"), F.lit(rank).alias("rank"), m["value"].alias("value")),
            SPAN,
        )

    found = F.filter(let(F.split(marked, MARKS[0], -1), spans), lambda s: F.length(s["value"]) >= least)
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(F.expr(f"cast(array() AS array<{SPAN}>)"))


def _codes(token: Column) -> Column:
    """Codes of a token's neighbouring pairs of ASCII characters, from 1 to 16384."""
    return let(
        F.transform(F.split(token, ""), F.ascii),
        lambda c: F.zip_with(
            F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda a, b: a * 128 + b + 1
        ),
    )


def train_markov(
    docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = 2000, made: int = 4000, smoothing: float = 0.5
) -> list[float]:
    """Log-likelihood ratio of each character pair, random against ordinary: 16,384 numbers.

    Two first-order Markov models over ASCII, P(next | this) with additive smoothing over
    the 66 characters of a token.  Labelled samples: random are `made` digests in hex and
    as many in base 64; ordinary are the identifiers (IDENTIFIER) of the `sample` documents
    with the smallest hash of their key, without what the fixed patterns find there.  Both
    bounds are parameters; the model has a fixed size and is all that reaches the driver.
    """
    spark = docs.sparkSession
    picked = docs.select(F.xxhash64(key).alias("h")).orderBy("h").limit(sample).agg(F.max("h").alias("h")).first()["h"]
    body = F.col(text)
    for _, pattern, _, _ in BASE:
        body = F.regexp_replace(body, F.lit(pattern), F.lit(" "))
    ordinary = (
        docs.filter(F.xxhash64(key) <= F.lit(picked)) if picked is not None else docs.limit(0)
    ).select(F.explode(F.regexp_extract_all(body, F.lit(IDENTIFIER), F.lit(0))).alias("token"), F.lit(0).alias("random"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    random = spark.range(made).select(
        F.explode(F.array(digest, F.translate(F.base64(F.unhex(digest)), "=", ""))).alias("token"), F.lit(1).alias("random")
    )
    pairs = (
        ordinary.union(random)
        .select("random", F.explode(_codes(F.col("token"))).alias("pair"))
        .groupBy("random", "pair")
        .count()
        .collect()  # at most 2 * 16,384 rows
    )
    counts = [[0.0] * 16384 for _ in range(2)]
    for row in pairs:
        counts[row["random"]][row["pair"] - 1] = row["count"]
    ratio = [0.0] * 16384
    totals = [[sum(c[a * 128 : a * 128 + 128]) for a in range(128)] for c in counts]
    for i in range(16384):
        logs = [math.log((c[i] + smoothing) / (t[i // 128] + 66 * smoothing)) for c, t in zip(counts, totals)]
        ratio[i] = round(logs[1] - logs[0], 4)
    return ratio


def scan(
    docs: DataFrame, model: list[float], key: str = "doc_id", text: str = "text", threshold: float = 12.0, shortest: int = 20
) -> DataFrame:
    """docs with a column `spans`: (start, end, rank, value) in order of start, then kind.

    The fixed patterns BASE, and every run of at least `shortest` LETTERS outside their
    spans whose summed log-likelihood ratio is at least threshold (kind "random"); shorter
    runs are too short for a likelihood to tell.  Time grows as a text's length.

    Null and empty texts have no spans.  Null keys, repeated keys and repeated rows are
    rows like any; spans that begin together stand in the order of KINDS.  A clashing
    column named spans is replaced, all others stay.  An empty table gives an empty one.
    """
    source = F.coalesce(F.col(text), F.lit(""))
    base = F.array_sort(F.concat(*(matches(source, p, i, group, least) for i, (_, p, group, least) in enumerate(BASE))))
    ratios = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")  # a constant, folded once

    def score(token: Column) -> Column:
        return F.aggregate(_codes(token), F.lit(0.0), lambda total, pair: total + F.element_at(ratios, pair))

    def bounded(block: Column) -> Column:
        return F.struct(
            block[0]["start"].alias("start"), F.array_max(F.transform(block, lambda b: b["end"])).alias("end"), block.alias("spans")
        )

    def meets(span: Column, other: Column) -> Column:
        return (other["start"] < span["end"]) & (other["end"] > span["start"])

    def all_of(found: Column) -> Column:
        def outside(blocks: Column) -> Column:
            free = lambda s: ~F.exists(
                blocks, lambda block: F.when(meets(s, block), F.exists(block["spans"], lambda b: meets(s, b))).otherwise(F.lit(False))
            )
            tokens = matches(source, f"{LETTERS}{{{shortest},}}", len(BASE))
            return F.filter(tokens, lambda s: (score(s["value"]) >= threshold) & free(s))

        blocks = F.transform(F.filter(blocks_of(found), lambda block: F.size(block) > 0), bounded)
        return F.array_sort(F.concat(found, let(blocks, outside)))

    return docs.withColumn("spans", let(base, all_of))


def kind_of(span: Column) -> Column:
    return F.element_at(F.array(*(F.lit(k) for k in KINDS)), span["rank"] + 1)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", kind_of(s), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, the number of spans of each fixed kind, the digest of the fixed spans, all spans."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    ranks = F.transform("spans", lambda s: s["rank"])
    numbers = [
        F.size(F.filter(ranks, (lambda kind: lambda rank: rank == kind)(i))).cast("long").alias(f"n_{name}")
        for i, (name, *_) in enumerate(BASE)
    ]
    return scanned.select(key, *numbers, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(scanned: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Every stretch covered by spans becomes one mark; the column spans is dropped.

    Overlapping spans are one stretch.  Texts without spans, and null texts, stay as they are.
    Time grows as a text's length.
    """
    body = F.col(text)

    def cleaned(chunks: Column) -> Column:
        def part(start: Column, end: Column) -> Column:
            """Characters from start to end, out of the chunks that hold them."""
            first = F.floor(start / CHUNK).cast("int")
            held = F.slice(chunks, first + 1, F.floor((end - 1) / CHUNK).cast("int") - first + 1)
            joined = F.substring(F.array_join(held, ""), start - first * CHUNK + 1, end - start)
            return F.when(end > start, joined).otherwise(F.lit(""))

        gaps = running(
            F.col("spans"),
            F.lit(0),
            lambda at, span: F.greatest(at, span["end"]),
            lambda at, span: F.when(span["start"] >= at, F.concat(part(at, span["start"]), F.lit(mark))).otherwise(F.lit("")),
            "string",
        )
        last = F.array_max(F.transform("spans", lambda span: span["end"]))
        return F.concat(F.array_join(gaps, ""), part(last, F.length(body)))

    whole = let(F.regexp_extract_all(body, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0)), cleaned)
    return scanned.withColumn(text, F.when(F.size("spans") > 0, whole).otherwise(body)).drop("spans")


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """train_markov and scan with their defaults."""
    return scan(docs, train_markov(docs, key, text), key, text)
