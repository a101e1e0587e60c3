"""License scans: an exact set-similarity join of text blocks with license templates.

A text's words are cut into blocks: for templates of up to ``s`` words (``s`` a
power of two, the template's stride) a block is ``2 s`` consecutive words, and
one starts at every ``s``-th word, so every passage as long as a template lies
whole in some block.  A block matches a template if it holds at least
``threshold`` of the template's distinct words.

The join is exact.  The words that templates use are ordered by the number of
blocks that hold them, over the whole table, the rarest first.  A match of
``need`` common words must then share one of the first ``len - need + 1`` words
of both sides (prefix filter); a block with fewer than ``need`` words of the
templates is left out (length filter), and so is a pair whose places of the
shared word leave too few words behind it (position filter).  What is left is
counted in full.

The blocks never move: template prefixes go to every task (they are a parameter
and their size is checked), and only matches are shuffled, reduced per document.

Edge cases: a NULL or empty text has no word, no label and score 0; repeated
rows are scanned one by one; an empty table gives no row; texts are scanned
whole; all other columns are left out of the result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftscore.llm.common import documents, store, text_batches

#: Share of a template's distinct words that a block must hold.
THRESHOLD = 0.8
#: Template words that may be sent to every task; more templates than this are to be scanned in several runs.
MOST_TEMPLATE_WORDS = 1_000_000

#: Phrases that always give their label.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Customary license notices, as public licenses state them.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("cc", "Licensed under CC BY-NC 4.0"),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
            "not distributed with this file, You can obtain one at"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Over UTF-8: letters in lower case, digits and all bytes outside ASCII stay, the rest separates.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z in lower case."""
    return text.translate(_BYTES).split()


class Templates:
    """Templates as sets of word numbers, by stride."""

    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD):
        self.rows = []  # template, label, stride, word numbers, need
        numbers: dict[bytes, int] = {}
        for k, (label, text) in enumerate(templates):
            seq = words(text.encode())
            if not seq:
                raise ValueError(f"template {k} ({label}) has no word")
            held = sorted({numbers.setdefault(w, len(numbers)) for w in seq})
            # A share of 0.8 of 5 words is 4, also where the product is a little above it.
            need = max(1, math.ceil(threshold * len(held) - 1e-9))
            self.rows.append((k, label, 1 << max(3, (len(seq) - 1).bit_length()), held, need))
        self.numbers = numbers
        if sum(len(r[3]) for r in self.rows) > MOST_TEMPLATE_WORDS:
            raise ValueError(f"more than {MOST_TEMPLATE_WORDS} template words: scan for fewer templates at a time")
        self.strides = sorted({r[2] for r in self.rows})
        self.used = {s: sorted({w for r in self.rows if r[2] == s for w in r[3]}) for s in self.strides}
        self.least = {s: min(r[4] for r in self.rows if r[2] == s) for s in self.strides}


def _phrase_places(seq: list[bytes], phrases: list[tuple[list[bytes], str]]) -> tuple[list[int], set[str]]:
    """Starts of the phrases in a text's words, and their labels."""
    starts, labels = [], set()
    for phrase, label in phrases:
        last, at = phrase[-1], -1
        while True:
            try:
                at = seq.index(last, at + 1)
            except ValueError:
                break
            first = at - len(phrase) + 1
            if first >= 0 and seq[first:at + 1] == phrase:
                starts.append(first)
                labels.add(label)
    return starts, labels


def _blocks(places: np.ndarray, numbers: np.ndarray, docs: np.ndarray, templates: Templates):
    """Blocks of a batch with enough words of the templates: arrays of document, stride, block and (sorted) word offsets."""
    found = []
    base = max(templates.numbers.values()) + 1
    for s in templates.strides:
        mine = np.isin(numbers, templates.used[s])
        if not mine.any():
            continue
        cell, n, d = places[mine] // s, numbers[mine], docs[mine]
        # A word of cell c lies in the blocks that start at cells c and c - 1.
        block = np.concatenate([cell, cell[cell > 0] - 1])
        n, d = np.concatenate([n, n[cell > 0]]), np.concatenate([d, d[cell > 0]])
        span = int(block.max()) + 1
        keys = np.unique((d * span + block) * base + n)
        owner, number = keys // base, keys % base
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        size = np.diff(np.r_[first, len(owner)])
        for f, z in zip(first[size >= templates.least[s]], size[size >= templates.least[s]]):
            found.append((int(owner[f] // span), s, int(owner[f] % span), number[f:f + z]))
    found.sort(key=lambda x: x[:3])
    return found


BLOCK = pa.struct([("stride", pa.int32()), ("block", pa.int64()), ("words", pa.list_(pa.int32()))])
SCANNED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                     ("last_word", pa.int64()), ("base", pa.list_(pa.string())), ("blocks", pa.list_(BLOCK))])


def scanned(docs: DataFrame, templates: Templates, phrases=PHRASES) -> DataFrame:
    """One pass over the texts: ``doc_id, n_words``, places and labels of phrases, blocks that pass the length filter."""
    text_batches(docs.sparkSession)
    split = [(words(p.encode()), label) for p, label in phrases]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = templates.numbers.get
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows, numbers, lengths = [], [], []
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).cast(pa.binary()).to_pylist()):
                    seq = words(text or b"")
                    starts, labels = _phrase_places(seq, split)
                    rows.append((doc_id, len(seq), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels)))
                    numbers.append(np.array([get(w, -1) for w in seq], dtype=np.int64))
                    lengths.append(len(seq))
                flat = np.concatenate(numbers)
                place = np.concatenate([np.arange(n) for n in lengths]) if len(flat) else flat
                owner = np.repeat(np.arange(len(lengths)), lengths)
                known = flat >= 0
                blocks = [[] for _ in rows]
                if known.any():
                    for d, s, b, held in _blocks(place[known], flat[known], owner[known], templates):
                        blocks[d].append({"stride": s, "block": b, "words": held.tolist()})
                columns = [*zip(*rows), blocks]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCANNED)], schema=SCANNED)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base array<string>, "
              "blocks array<struct<stride int, block long, words array<int>>>")


def matches(blocks: DataFrame, templates: Templates) -> DataFrame:
    """The join: ``row, stride, block, template, common`` for every block that holds enough of a template.

    ``blocks`` has ``row, stride, block, words``, is read twice and must give the same rows each time.
    """
    spark = blocks.sparkSession
    # At most one count for each word of the templates comes back.
    counts = {(r.stride, r.word): r.n for r in blocks.select("stride", F.explode("words").alias("word"))
              .groupBy("stride", "word").agg(F.count("*").alias("n")).collect()}
    place = {s: {w: k for k, w in enumerate(sorted(templates.used[s], key=lambda w: (counts.get((s, w), 0), w)))}
             for s in templates.strides}
    width = len(templates.numbers)
    order = F.create_map(*[c for s in templates.strides for c in (
        F.lit(s), F.array(*[F.lit(place[s].get(w, -1)) for w in range(width)]))])
    prefixes = []
    for k, _, s, held, need in templates.rows:
        ranks = sorted(place[s][w] for w in held)
        prefixes += [(k, s, ranks[q], q, len(held), need, ranks) for q in range(len(held) - need + 1)]
    side = spark.createDataFrame(
        prefixes, "template int, t_stride int, t_word int, t_at int, t_size int, need int, t_words array<int>")
    least = F.create_map(*[F.lit(x) for s in templates.strides for x in (s, templates.least[s])])
    ordered = (blocks.withColumn("_order", order[F.col("stride")])
               .withColumn("ranks", F.array_sort(F.transform("words", lambda w: F.col("_order")[w])))
               .select("row", "stride", "block", "ranks", F.size("ranks").alias("size"), least[F.col("stride")].alias("least")))
    probes = ordered.select("*", F.posexplode(F.slice("ranks", F.lit(1), F.col("size") - F.col("least") + 1)).alias("at", "word"))
    room = 1 + F.least(F.col("size") - F.col("at"), F.col("t_size") - F.col("t_at")) - 1
    found = probes.join(F.broadcast(side), (F.col("stride") == F.col("t_stride")) & (F.col("word") == F.col("t_word")) & (room >= F.col("need")))
    return (found.withColumn("common", F.size(F.array_intersect("ranks", "t_words"))).where("common >= need")
            .select("row", "stride", "block", "template", "common", "t_size"))


def license_blocks(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, phrases=PHRASES) -> tuple[DataFrame, DataFrame]:
    """The scanned documents (with a ``row`` of their own) and every matching block.

    The second frame has ``row, start, n_words, template, label, containment``: the block is the ``n_words`` words from
    ``start`` on (fewer at the end of the text), and holds that share of the template's distinct words.
    """
    made = Templates(templates, threshold)
    table = store(scanned(docs, made, phrases).withColumn("row", F.monotonically_increasing_id()), "license-blocks")
    blocks = table.where(F.size("blocks") > 0).select("row", F.inline("blocks"))
    labels = F.create_map(*[F.lit(x) for r in made.rows for x in (r[0], r[1])])
    found = matches(blocks, made).distinct().select(
        "row", (F.col("block") * F.col("stride")).alias("start"), (F.col("stride") * 2).alias("n_words"), "template",
        labels[F.col("template")].alias("label"), (F.col("common") / F.col("t_size")).alias("containment"))
    return table, found


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and matching templates of every document; ``score`` is the greatest containment found, 1 for a phrase."""
    table, found = license_blocks(documents(spark, sf_dir))
    per = found.groupBy(F.col("row").alias("_row")).agg(
        F.max("containment").alias("_best"), F.collect_set("label").alias("_labels"), F.count_distinct("start", "n_words").alias("n_blocks"))
    nothing = F.array().cast("array<string>")
    return table.join(per, F.col("row") == F.col("_row"), "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("_labels", nothing))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"))


def oracle(templates=TEMPLATES, threshold: float = THRESHOLD, phrases=PHRASES) -> str:
    """The same over ``documents`` in DuckDB: every block is compared with every template of its stride."""
    made = Templates(templates, threshold)
    names = [w.decode() for w in made.numbers]
    quote = lambda w: "'" + w.replace("'", "''") + "'"
    rows = ", ".join(f"({k}, {quote(label)}, {s}, [{', '.join(quote(names[w]) for w in held)}], {need})" for k, label, s, held, need in made.rows)
    bases = ", ".join(f"({quote(label)}, [{', '.join(map(quote, re.findall(WORD, p)))}])" for p, label in phrases)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH t(template, label, stride, held, need) AS (VALUES {rows}),
p(label, phrase) AS (VALUES {bases}),
d AS (SELECT row_number() OVER () AS id, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') AS w FROM documents),
placed AS (SELECT d.id, p.label, x.i - 1 AS start FROM d, p, unnest(range(1, len(d.w) - len(p.phrase) + 2)) AS x(i)
       WHERE d.w[x.i] = p.phrase[1] AND d.w[x.i:x.i + len(p.phrase) - 1] = p.phrase),
base AS (SELECT id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
                array_agg(DISTINCT label) AS labels FROM placed GROUP BY id),
strides AS (SELECT DISTINCT stride FROM t),
blocks AS (SELECT d.id, s.stride, x.b AS block, list_distinct(d.w[x.b * s.stride + 1:x.b * s.stride + 2 * s.stride]) AS held
           FROM d, strides s, unnest(range(0, (len(d.w) + s.stride - 1) // s.stride)) AS x(b)),
hits AS (SELECT b.id, b.stride, b.block, t.label, len(list_intersect(b.held, t.held)) / len(t.held) AS share
         FROM blocks b JOIN t USING (stride) WHERE len(list_intersect(b.held, t.held)) >= t.need),
per AS (SELECT id, max(share) AS best, array_agg(DISTINCT label) AS labels, count(DISTINCT (stride, block)) AS n_blocks FROM hits GROUP BY id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(base.n_base, 0)::BIGINT AS n_base,
       base.first_word::BIGINT AS first_word, base.last_word::BIGINT AS last_word,
       array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(per.labels, [])))), ',') AS labels,
       CASE WHEN base.n_base > 0 THEN 1.0 ELSE coalesce(per.best, 0) END::DOUBLE AS score,
       coalesce(per.n_blocks, 0)::BIGINT AS n_blocks
FROM d LEFT JOIN base USING (id) LEFT JOIN per USING (id)"""


ORACLE = oracle()
