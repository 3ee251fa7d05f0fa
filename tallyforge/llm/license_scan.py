"""Licence scans: TF-IDF cosine to templates, then inheritance from the nearest directory.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.scratch import store

# Words that a line of a licence note has one of, and names of licence files.
VOCABULARY = r"licen[cs]e|copyright|permission|redistribut|warrant|liab|rights reserved|spdx|public domain"
NOTE = rf"(?im)(?:^.*(?:{VOCABULARY}).*$\n?)+"
NOT_NOTED = rf"(?imd)^(?!.*(?:{VOCABULARY})).*"  # a line outside notes; Java's regex takes NOTE by recursion, a level a line
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|copyright|notice|unlicense)([.-].*)?$"

# Texts by which licences are known (short notes and the first sentences of headers).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: neither the name of the copyright holder nor the names of its contributors may be used to endorse"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: redistributions of source code must retain the above copyright notice"),
    ("GPL", "This work is licensed under the GNU General Public License."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL", "Licensed under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("Proprietary", "All rights reserved."),
)


def words(text: Column) -> Column:
    """Lower-case words of letters, digits and inner dots."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9.]+", " "), r"[.]+( |$)", " ")
    return F.filter(F.split(plain, " +"), lambda w: w != "")


def scan(
    files: DataFrame, key: str, path: str, text: str, threshold: float = 0.6, share: float = 0.5, templates=TEMPLATES
) -> DataFrame:
    """One row per row of files: key, licence, score, inherited_from.

    A note is a run of lines that each have a word of VOCABULARY.  Equal notes are scored
    once: the cosine of their TF-IDF vector with each template's, where the inverse
    document frequency counts the notes of all files.  A file's licence is that of its
    best note with a score of at least threshold; ties take the first name.

    A licence file (by name, or because a note makes up at least `share` of its words)
    gives its licence to its directory; of several the best score, then the first name.
    A file without a note of its own takes over the licence of the nearest directory
    above it, in a join on the paths of its ancestors; inherited_from names that
    directory ("" is the root) and score is that of the licence file.

    Words are aggregated before they are shuffled and templates are a fixed list, so a
    note that a third of all files bear is one row; a directory with as many files is a
    skewed join with short rows, which adaptive execution splits.

    Null and empty texts, and texts without a note, have no licence of their own; null
    paths are files of the root.  Rows that repeat a key or a path are rows of their own.
    Null keys are handled like any.  Other columns are not read.  An empty table gives an
    empty one.
    """
    spark = files.sparkSession
    source = files.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(key).alias("_key"),
        F.coalesce(F.col(path), F.lit("")).alias("_path"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    runs = F.split(F.regexp_replace("_text", NOT_NOTED, ""), "\n\n+")  # emptied lines part the notes
    notes = F.when(F.rlike("_text", F.lit(f"(?i){VOCABULARY}")), runs)
    noted, _ = store(source.select(
        "_row", "_key", "_path", F.coalesce(F.transform(notes, lambda n: F.array_join(words(n), " ")), F.array()).alias("_notes"),
        F.when(notes.isNotNull(), F.size(words(F.col("_text")))).alias("_size"),
    ), "notes")  # the texts are read once
    borne = noted.select("_row", "_key", "_path", "_size", F.explode("_notes").alias("text")).filter("text <> ''")
    borne = borne.withColumn("note", F.sha2("text", 256))  # rows per word bear this, not the text
    scored = _scores(spark, borne.groupBy("note", "text").agg(F.count("*").alias("files")), templates)
    own = (
        borne.join(scored.filter(F.col("score") >= threshold), "note")
        .withColumn("_share", F.size(F.split("text", " ")) / F.col("_size"))
        .groupBy("_row")
        .agg(
            F.min_by(F.struct("licence", "score", "_share", "_path"), F.struct(-F.col("score"), F.col("licence"))).alias("best")
        )
        .select("_row", "best.*")
    )
    name, directory = F.element_at(F.split("_path", "/"), -1), F.regexp_replace("_path", r"/?[^/]*$", "")
    given = (
        own.filter((F.col("_share") >= share) | F.rlike(name, F.lit(LICENCE_FILE)))
        .groupBy(directory.alias("_from"))
        .agg(F.min_by(F.struct("licence", "score"), F.struct(-F.col("score"), F.col("licence"))).alias("given"))
    )
    parts = F.split("_path", "/")
    ancestors = F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("_from"))
    )
    rest = noted.select("_row", "_path").join(own.select("_row"), "_row", "left_anti")
    inherited = (
        rest.select("_row", F.explode(ancestors).alias("_up"))
        .select("_row", "_up.*")
        .join(given, "_from")
        .groupBy("_row")
        .agg(F.max_by(F.struct("given.licence", "given.score", "_from"), "depth").alias("got"))
        .select("_row", "got.*")
    )
    found = own.select("_row", "licence", "score", F.lit(None).cast("string").alias("_from")).unionByName(inherited)
    return (
        noted.select("_row", "_key")
        .join(found, "_row", "left")
        .select(F.col("_key").alias(key), "licence", F.round("score", 6).alias("score"), F.col("_from").alias("inherited_from"))
    )


def _scores(spark: SparkSession, notes: DataFrame, templates) -> DataFrame:
    """note, licence, score of the best template of every note (columns note, text, files)."""
    entries = F.array(*(F.struct(F.lit(i).alias("t"), F.lit(name).alias("licence"), F.lit(text).alias("text")) for i, (name, text) in enumerate(templates)))
    known = spark.range(1).select(F.explode(entries).alias("e")).select("e.*")
    of_notes = notes.select("note", "files", F.explode(F.split("text", " ")).alias("word")).groupBy("note", "files", "word").agg(F.count("*").alias("tf"))
    of_templates = known.select("t", "licence", F.explode(words(F.col("text"))).alias("word")).groupBy("t", "licence", "word").agg(F.count("*").alias("tf"))
    frequency = of_notes.groupBy("word").agg(F.sum("files").alias("df"))
    total = notes.agg(F.coalesce(F.sum("files"), F.lit(0))).scalar()
    weight = F.col("tf") * (F.log((1 + total) / (1 + F.coalesce("df", F.lit(0)))) + 1)
    of_notes = of_notes.join(frequency, "word").withColumn("w", weight)
    of_templates = of_templates.join(frequency, "word", "left").withColumn("w", weight)
    note_norm = of_notes.groupBy("note").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    template_norm = of_templates.groupBy("t").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("t_norm"))
    shared = of_notes.select("note", "word", "w").join(
        F.broadcast(of_templates.select("t", "licence", "word", F.col("w").alias("t_w"))), "word"  # a fixed list's words
    )
    dots = shared.groupBy("note", "t", "licence").agg(F.sum(F.col("w") * F.col("t_w")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 9)
    return (
        dots.join(note_norm, "note")
        .join(F.broadcast(template_norm), "t")
        .withColumn("score", cosine)
        .groupBy("note")
        .agg(F.min_by(F.struct("licence", "score"), F.struct(-F.col("score"), F.col("licence"))).alias("best"))
        .select("note", "best.*")
    )


def oracle(path: str, table: str = "documents", threshold: float = 0.6, share: float = 0.5) -> str:
    """scan() in DuckDB's SQL, for doc_id and text of table and an SQL expression of the path."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    words_of = lambda x: (
        f"list_filter(string_split_regex(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9.]+', ' ', 'g'),"
        f" '[.]+( |$)', ' ', 'g'), ' +'), lambda w: w <> '')"
    )
    rows = ", ".join(f"({i}, {quoted(n)}, {quoted(t)})" for i, (n, t) in enumerate(TEMPLATES))
    weight = "tf * (ln((1 + n) / (1 + coalesce(df, 0))) + 1)"
    return rf"""
    WITH source AS (SELECT row_number() OVER () AS r, doc_id, {path} AS path, coalesce(text, '') AS text FROM {table}),
    borne AS (
        SELECT r, path, text, array_to_string({words_of("raw")}, ' ') AS note FROM (
            SELECT r, path, text, unnest(regexp_extract_all(text, {quoted(NOTE)})) AS raw FROM source
            WHERE regexp_matches(text, {quoted("(?i)" + VOCABULARY)}))),
    notes AS (SELECT note, count(*) AS files FROM borne WHERE note <> '' GROUP BY note),
    note_words AS (SELECT note, files, word, count(*) AS tf FROM
        (SELECT note, files, unnest(string_split(note, ' ')) AS word FROM notes) GROUP BY ALL),
    templates(t, licence, body) AS (VALUES {rows}),
    template_words AS (SELECT t, licence, word, count(*) AS tf FROM
        (SELECT t, licence, unnest({words_of("body")}) AS word FROM templates) GROUP BY ALL),
    frequency AS (SELECT word, sum(files) AS df FROM note_words GROUP BY word),
    total AS (SELECT coalesce(sum(files), 0) AS n FROM notes),
    weighted AS (SELECT note, word, {weight} AS w FROM note_words JOIN frequency USING (word), total),
    known AS (SELECT t, licence, word, {weight} AS w FROM template_words LEFT JOIN frequency USING (word), total),
    norms AS (SELECT note, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY note),
    t_norms AS (SELECT t, sqrt(sum(w * w)) AS t_norm FROM known GROUP BY t),
    cosines AS (SELECT note, licence, round(sum(weighted.w * known.w) / (any_value(norm) * any_value(t_norm)), 9) AS score
        FROM weighted JOIN known USING (word) JOIN norms USING (note) JOIN t_norms USING (t) GROUP BY note, t, licence),
    best AS (SELECT note, licence, score FROM cosines
        QUALIFY row_number() OVER (PARTITION BY note ORDER BY score DESC, licence) = 1),
    own AS (SELECT r, path, licence, score, len(string_split(note, ' ')) / len({words_of("text")}) AS share
        FROM borne JOIN best USING (note) WHERE score >= {threshold}
        QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, licence, share, path) = 1),
    given AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, licence, score FROM own
        WHERE share >= {share} OR regexp_matches(string_split(path, '/')[-1], {quoted(LICENCE_FILE)})
        QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, licence) = 1),
    up AS (SELECT r, depth, array_to_string(string_split(path, '/')[1:depth], '/') AS dir FROM
        (SELECT r, path, unnest(range(0, len(string_split(path, '/')))) AS depth FROM source WHERE r NOT IN (SELECT r FROM own))),
    inherited AS (SELECT r, licence, score, dir FROM up JOIN given USING (dir)
        QUALIFY row_number() OVER (PARTITION BY r ORDER BY depth DESC) = 1),
    found AS (SELECT r, licence, score, NULL AS dir FROM own UNION ALL SELECT * FROM inherited)
    SELECT doc_id, licence, round(score, 6) AS score, dir AS inherited_from FROM source LEFT JOIN found USING (r)
    """
