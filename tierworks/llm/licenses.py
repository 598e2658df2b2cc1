"""License scans by diagonal voting.

Words of a document and of license templates are compared through rolling hashes of word
pairs: every pair of the document is joined by hash to the positions it has in templates, and
each hit votes for the diagonal (document position minus template position) it lies on.
An unbroken occurrence of a template is one diagonal with all its votes. Diagonals with
too few votes are noise; neighbouring ones of one template are merged, which bridges
words that were put in or left out, and a merged span is verified by the share of
different template positions it covers and by its length. Where a repeated phrase makes
neighbours of so many diagonals that their span is too long, the best of its diagonals
with those next to it is verified instead.

Only hits are shuffled, and one mark per document, which carries its number of words.

Defined cases: a null text is empty and has no words. Equal rows each give a row (they
are told apart by a row number within one job). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tierworks.llm.common import staged

GRAM = 2
# Words are runs of ASCII digits, letters (upper-case ones lower-cased) and all other
# characters beyond ASCII; every other byte of the UTF-8 text becomes a space.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
# The hash of the row that stands for a document itself, and rows sent to Spark at once.
MARK = 0
ROWS = 1 << 17

#: Phrases of which every unbroken place counts, as (label, phrase); fixed values.
BASE_TEMPLATES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]

#: Public license notices, as (label, notice); fixed values.
NOTICES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
            "terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International "
              "License"),
]

# A diagonal counts from this many votes (or all pairs of a shorter template), diagonals
# this close are merged, and a span is a license if it covers this share of the pairs.
MIN_VOTES = 2
NEIGHBOUR = 3
MIN_COVER = 0.7


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def rolling(words: list[bytes]) -> np.ndarray:
    """A hash for each ``GRAM`` words in a row, rolled from the hashes of the words."""
    hashed = xxhash.xxh64_intdigest
    each = np.array([hashed(w) for w in words], dtype=np.uint64)
    n = max(0, len(words) - GRAM + 1)
    grams = np.zeros(n, dtype=np.uint64)
    for i in range(GRAM):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + each[i : i + n]
    return grams.view(np.int64)


def template_grams(spark: SparkSession, base=None, notices=None) -> DataFrame:
    """(hash, template, label, is_base, grams, at) with a row for each pair of a template."""
    rows = []
    entries = [(*t, True) for t in (BASE_TEMPLATES if base is None else base)]
    entries += [(*t, False) for t in (NOTICES if notices is None else notices)]
    for number, (label, text, is_base) in enumerate(entries):
        pairs = rolling(words_of(text.encode())).tolist()
        if not pairs:
            raise ValueError(f"a template needs {GRAM} words: {text!r}")
        rows += [(h, number, label, is_base, len(pairs), i) for i, h in enumerate(pairs)]
    return spark.createDataFrame(
        rows, "hash long, template int, label string, is_base boolean, grams int, at int"
    )


def _rolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_no, doc_id, text) to (row_no, doc_id, n_words, pos, hash); pos -1 marks the document."""
    names = ["row_no", "doc_id", "n_words", "pos", "hash"]

    def joined(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        owner, counts, hashes = zip(*parts, strict=True)
        sizes = np.array([len(h) for h in hashes])
        rows = np.repeat(np.array(owner), sizes)
        ends = np.cumsum(sizes)
        pos = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) - 1
        table = pa.RecordBatch.from_arrays(
            [row_no.take(pa.array(rows)), doc_id.take(pa.array(rows)),
             pa.array(np.repeat(np.array(counts), sizes)), pa.array(pos),
             pa.array(np.concatenate(hashes))],
            names=names,
        )
        for at in range(0, table.num_rows, ROWS):
            yield table.slice(at, ROWS)

    for batch in batches:
        row_no, doc_id = batch.column("row_no"), batch.column("doc_id")
        waiting, held = [], 0
        for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            words = words_of(text or b"")
            marked = np.concatenate([np.array([MARK], dtype=np.int64), rolling(words)])
            waiting.append((i, len(words), marked))
            held += len(marked)
            if held >= ROWS:
                yield from joined(waiting)
                waiting, held = [], 0
        if waiting:
            yield from joined(waiting)


def hits(df: DataFrame, templates: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every word pair of every document at every place it has in a template.

    Pairs meet by 64-bit hashes; over 10 ** 14 pairs and some hundred template places the
    chance of one false hit is about one in a thousand.
    """
    mark = df.sparkSession.createDataFrame([(MARK,)], "hash long").select(
        "hash", *[F.lit(None).cast(t).alias(c) for c, t in templates.dtypes if c != "hash"]
    )
    rolled = df.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col(key).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
    ).mapInArrow(_rolled, "row_no long, doc_id long, n_words long, pos long, hash long")
    # Read from a file the templates have a known size: a short list is broadcast.
    known = staged(templates.unionByName(mark), "license-templates")
    return rolled.join(known, "hash").withColumn(
        "diagonal", F.col("pos") - F.col("at")
    )


def spans(found: DataFrame) -> DataFrame:
    """Hits to verified spans, and one row without template for each document."""
    voted = (
        found.groupBy("row_no", "doc_id", "n_words", "template", "label", "is_base", "grams",
                      "diagonal")
        .agg(F.min("pos").alias("start"), F.max("pos").alias("end"),
             F.collect_set("at").alias("covered"))
    )
    votes = F.size("covered")
    enough = F.when(F.col("is_base"), votes == F.col("grams")).otherwise(
        votes >= F.least(F.col("grams"), F.lit(MIN_VOTES))
    )
    voted = voted.filter(F.col("template").isNull() | enough)
    along = Window.partitionBy("row_no", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    # An unbroken base phrase is a place of its own, however close the next one is.
    fresh = F.when(gap.isNull() | F.col("is_base") | (gap > NEIGHBOUR), 1).otherwise(0)
    next_to = along.rangeBetween(0, NEIGHBOUR)
    near = F.struct(
        _union(F.collect_list("covered").over(next_to)).alias("covered"),
        (-F.min("start").over(next_to)).alias("before"),
        (F.max("end").over(next_to) + GRAM).alias("end"),
    )
    merged = (
        voted.withColumns({"fresh": fresh, "near": near})
        .withColumn("span", F.sum("fresh").over(along))
        .groupBy("row_no", "doc_id", "n_words", "template", "label", "is_base", "grams", "span")
        .agg(F.min("start").alias("start"), (F.max("end") + GRAM).alias("end"),
             _union(F.collect_list("covered")).alias("covered"), F.max("near").alias("near"))
    )
    fits = F.col("end") - F.col("start") <= 2 * (F.col("grams") + 1)
    pick = lambda whole, part: F.when(F.col("is_base") | fits, whole).otherwise(part)
    narrowed = merged.select(
        "row_no", "doc_id", "n_words", "template", "label", "is_base", "grams",
        pick(F.col("start"), -F.col("near.before")).alias("start"),
        pick(F.col("end"), F.col("near.end")).alias("end"),
        (pick(F.col("covered"), F.col("near.covered")) / F.col("grams")).alias("cover"),
    )
    return narrowed.filter(F.col("template").isNull() | (F.col("cover") >= MIN_COVER))


def _union(lists: Column) -> Column:
    """How many different positions the lists hold."""
    return F.size(F.array_distinct(F.flatten(lists)))


def _listed(condition: Column) -> Column:
    labels = F.array_sort(F.collect_set(F.when(condition, F.col("label"))))
    return F.concat_ws(",", labels)


def scan(
    df: DataFrame, text: str = "text", key: str = "doc_id", templates: DataFrame | None = None
) -> DataFrame:
    """One row per row of ``df``.

    doc_id, n_words, n_base (places of base phrases), first_word and last_word (their
    smallest and largest start in words), base_labels, labels (with those of notices),
    and score, the best cover of a verified span (1 for a base phrase, 0 without any).
    """
    table = template_grams(df.sparkSession) if templates is None else templates
    base, any_span = F.col("is_base"), F.col("template").isNotNull()
    return (
        spans(hits(df, table, text, key))
        .groupBy("row_no", "doc_id", "n_words")
        .agg(
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("start"))).alias("first_word"),
            F.max(F.when(base, F.col("start"))).alias("last_word"),
            _listed(base).alias("base_labels"),
            _listed(any_span).alias("labels"),
            F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        )
        .drop("row_no")
    )
