"""License scans by diagonal voting.

Templates (exact phrases and notice texts) are laid out as rolling word k-grams with their positions. Every k-gram of every
text is joined to them in Spark by a 64-bit hash and by the numbers of its words among the templates' words, which are
compared byte by byte: so each vote is verified on the actual words. A hit votes for the diagonal on which the text's word
and the template's word lie (text position less template position). Votes are aggregated by diagonal.

A phrase stands where all its k-grams vote for one diagonal. A notice may have words added or left out, so neighbouring
diagonals are merged while each is at most a quarter of the notice (MOST_GAP at least) from the one before. The places that
a merged span holds are united, so a place voted for twice counts once. A span counts if it holds COVERED of the notice's
places and all places of its key, the words that tell the notice from its siblings. Where counting spans of different
labels overlap, one with fewer places gives way to one with more (then the larger share, then the earlier template).

Only hits are ever grouped; the templates, whose number and length are fixed parameters, are what is broadcast.

Defined cases: a null or empty text has no words; texts of fewer than K words have no k-grams; a null doc_id is kept;
repeated rows (equal doc_id and text) vote once and each get the result; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm import tables, words

K = 2
#: Diagonals of a notice are merged up to this distance, or a quarter of its k-grams if that is more.
MOST_GAP = 4
#: A notice counts if its merged diagonals hold this share of its places.
COVERED = 0.7
#: Diagonals of notices with fewer votes are chance meetings of common words.
LEAST_VOTES = 2
_CHUNK = 60
#: Overlaps of spans are looked for within stretches of so many words.
_STRETCH = 256
SMALL_TEMPLATES = 100_000
SMALL_HITS = 200_000

#: Phrases that count wherever their words stand together, and their labels (fixed values).
PHRASES = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))
#: Notices: label, the wording that public licenses ask for, and its key (fixed values). The key is the part of the wording
#: that tells the notice from others; without one, the share of the wording decides.
NOTICES = (
    ("apache", "Licensed under the Apache License, Version 2.0", "apache license"),
    ("apache", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.', ""),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", "attribution 4"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "by nc"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "attribution noncommercial"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "by sa"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "attribution sharealike"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", "gnu general public license"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gnu general public license"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.", ""),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ""),
    ("mit", "Released under the MIT License", "mit license"),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so', ""),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla public license"),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0", "nc nd"),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "noncommercial noderivatives"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0", "nc sa"),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "noncommercial sharealike"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", "by nd"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", "attribution noderivatives"),
)


def _words(text: str) -> list[bytes]:
    (texts,) = words.chunks(pa.array([text]))
    w = texts.words(words.ALNUM, fold=True)
    raw = w.bytes.tobytes()
    return [raw[a:b] for a, b in zip(w.starts.tolist(), w.ends.tolist())]


class Vocabulary:
    """The templates' words, numbered from 1. A text's word has a word's number only if all its bytes are equal."""

    def __init__(self, texts: list[str]):
        known = sorted({x for t in texts for x in _words(t)})
        (piece,) = words.chunks(pa.array([b" ".join(known).decode()]))
        w = piece.words(words.ALNUM)
        order = np.argsort(w.hashes())
        self.hashes, self.sizes = w.hashes()[order], (w.ends - w.starts)[order]
        self.blocks = [w.block(np.minimum(w.starts + j, w.ends), np.maximum(w.ends - w.starts - j, 0))[order] for j in range(0, int(self.sizes.max(initial=1)), 8)]

    def numbers(self, w: words.Words, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = np.flatnonzero(self.hashes[at] == hashes)
        own, size = at[found], (w.ends - w.starts)[found]
        same = self.sizes[own] == size
        for j, block in enumerate(self.blocks):
            same &= w.block(np.minimum(w.starts[found] + 8 * j, w.ends[found]), np.maximum(size - 8 * j, 0)) == block[own]
        out = np.zeros(len(w), np.int64)
        out[found[same]] = own[same] + 1
        return out


def grams(texts: words.Texts, known: Vocabulary, k: int = K) -> tuple[words.Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, hash and proof (the words' numbers) of every k-gram, and the k-grams' bounds by text."""
    w = texts.words(words.ALNUM, fold=True)
    h = w.hashes()
    hashes, at = words.rolling(h, w.bounds, k)
    number = known.numbers(w, h)
    proof = np.zeros(len(at), np.int64)
    for j in range(k):
        proof = proof * (len(known.hashes) + 1) + number[at + j]
    return w, hashes, proof, np.searchsorted(at, w.bounds)


def _text_hashes(w: words.Words, texts: words.Texts) -> np.ndarray:
    return w.spans(texts.offsets[:-1], texts.offsets[1:]).view(np.int64)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in words.chunks(batch.column(1)):
            w = texts.words(words.ALNUM, fold=True)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.first, len(texts)), pa.array(_text_hashes(w, texts)), pa.array(w.counts.astype(np.int64))], ["doc_id", "h", "n_words"])


def _grams(known: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.chunks(batch.column(1)):
                w, hashes, proof, bounds = grams(texts, known)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.first, len(texts)), pa.array(_text_hashes(w, texts)), _lists(hashes, bounds), _lists(proof, bounds)], ["doc_id", "h", "gram", "proof"])

    return run


def _templates(phrases, notices) -> list[tuple[bool, str, str, str]]:
    """exact, label, text, key; a phrase is all key."""
    return [(True, label, text, text) for label, text in phrases] + [(False, *n) for n in notices]


def template_table(spark: SparkSession, known: Vocabulary, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """gram, proof, template, label, phrase (exact), place, key (whether the place is part of the key), n and n_key (places of the template and of its key)."""
    rows = []
    for number, (exact, label, text, key) in enumerate(_templates(phrases, notices)):
        (texts,) = words.chunks(pa.array([text]))
        _, hashes, proof, _ = grams(texts, known)
        if not len(hashes):
            raise ValueError(f"a template needs {K} words: {text!r}")
        ws, own = _words(text), _words(key)
        at = next((i for i in range(len(ws)) if ws[i : i + len(own)] == own), None)
        if at is None or 0 < len(own) < K:
            raise ValueError(f"a key is empty, or {K} words or more of its notice: {key!r}")
        n_key = max(0, len(own) - K + 1)
        rows += [(int(g), int(p), number, label, exact, i, at <= i < at + n_key, len(hashes), n_key) for i, (g, p) in enumerate(zip(hashes.view(np.int64), proof))]
    return spark.createDataFrame(rows, "gram long, proof long, template int, label string, phrase boolean, place int, key boolean, n int, n_key int")


_BY = ["doc_id", "h", "template", "label", "phrase", "n", "n_key"]


def diagonals(docs: DataFrame, templates: DataFrame, known: Vocabulary) -> DataFrame:
    """Votes of each diagonal: doc_id, h, template, label, phrase, n, n_key, diagonal, part (of the template) and the bits of the places and key places voted for."""
    coded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_grams(known), "doc_id long, h long, gram array<long>, proof array<long>")
    every = coded.select("doc_id", "h", F.posexplode(F.arrays_zip("gram", "proof")).alias("pos", "g")).select("doc_id", "h", "pos", F.col("g.gram").alias("gram"), F.col("g.proof").alias("proof"))
    hits = every.join(tables.small(templates, SMALL_TEMPLATES), ["gram", "proof"])
    hits = hits.withColumns({"diagonal": F.col("pos") - F.col("place"), "part": F.floor(F.col("place") / _CHUNK), "bit": F.expr(f"shiftleft(1L, place % {_CHUNK})")})
    return hits.groupBy(*_BY, "diagonal", "part").agg(F.bit_or("bit").alias("bits"), F.bit_or(F.when(F.col("key"), F.col("bit")).otherwise(F.lit(0).cast("long"))).alias("keys"), F.min("place").alias("first"), F.max("place").alias("last"))


def phrase_places(votes: DataFrame) -> DataFrame:
    """doc_id, h, label, at: where phrases stand whole."""
    whole = votes.where("phrase").groupBy(*_BY, "diagonal").agg(F.sum(F.bit_count("bits")).alias("votes"))
    return whole.where(F.col("votes") == F.col("n")).select("doc_id", "h", "label", F.col("diagonal").alias("at"))


def spans(votes: DataFrame) -> DataFrame:
    """Diagonals of notices merged with their neighbours: doc_id, h, template, label, places (distinct), covered (0 to 1), start, end (words), counts."""
    by_diagonal = Window.partitionBy("doc_id", "h", "template", "diagonal")
    of = Window.partitionBy("doc_id", "h", "template").orderBy("diagonal")
    df = votes.where(~F.col("phrase")).withColumn("votes", F.sum(F.bit_count("bits")).over(by_diagonal))
    df = df.where(F.col("votes") >= F.least(F.lit(LEAST_VOTES), F.col("n")))
    far = F.col("diagonal") - F.lag("diagonal").over(of) > F.greatest(F.lit(MOST_GAP), F.floor(F.col("n") / 4))
    df = df.withColumn("new", F.coalesce(far, F.lit(True)).cast("int"))
    df = df.withColumn("island", F.sum("new").over(of.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    start, end = F.min(F.col("diagonal") + F.col("first")), F.max(F.col("diagonal") + F.col("last") + K)
    united = df.groupBy(*_BY, "island", "part").agg(F.bit_or("bits").alias("bits"), F.bit_or("keys").alias("keys"), start.alias("start"), end.alias("end"))
    merged = united.groupBy(*_BY, "island").agg(F.sum(F.bit_count("bits")).alias("places"), F.sum(F.bit_count("keys")).alias("key_places"), F.min("start").alias("start"), F.max("end").alias("end"))
    covered = (F.col("places") / F.col("n")).alias("covered")
    return merged.select("doc_id", "h", "template", "label", "places", covered, "start", "end", ((covered >= COVERED) & (F.col("key_places") == F.col("n_key"))).alias("counts"))


def winners(found: DataFrame) -> DataFrame:
    """found: stored rows of spans() that count. Those that no overlapping span of another label beats."""
    stretches = F.explode(F.sequence(F.floor(F.col("start") / _STRETCH), F.floor((F.col("end") - 1) / _STRETCH)))
    rows = found.withColumn("stretch", stretches)
    rival = rows.select(*[F.col(c).alias(f"_{c}") for c in rows.columns])
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("h") == F.col("_h")) & (F.col("stretch") == F.col("_stretch"))
    overlap = (F.col("label") != F.col("_label")) & (F.col("start") < F.col("_end")) & (F.col("_start") < F.col("end"))
    better = F.struct(-F.col("_places"), -F.col("_covered"), "_template") < F.struct(-F.col("places"), -F.col("covered"), "template")
    beaten = rows.join(rival, same & overlap & better, "left_semi").select("doc_id", "h", "template", "start").distinct()
    beaten = beaten.withColumnsRenamed({c: f"_{c}" for c in beaten.columns})
    return found.join(beaten, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("h") == F.col("_h")) & (F.col("template") == F.col("_template")) & (F.col("start") == F.col("_start")), "left_anti")


@tables.tidy
def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """docs (doc_id, text) to doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans (of notices found)."""
    spark = docs.sparkSession
    tables.ship(spark)
    known = Vocabulary([text for _, _, text, _ in _templates(phrases, notices)])
    templates = tables.stored(template_table(spark, known, phrases, notices).repartition(1), "license-templates")
    votes = tables.stored(diagonals(docs, templates, known), "license-votes")
    merged = tables.stored(spans(votes), "license-spans")
    none = F.lit(None)
    exact = phrase_places(votes).select("doc_id", "h", F.struct("label", "at", none.cast("double").alias("covered"), none.cast("int").alias("end")).alias("s"), F.lit(1.0).alias("score"))
    won = winners(merged.where("counts")).select("doc_id", "h", F.struct("label", F.col("start").alias("at"), "covered", "end").alias("s"), F.col("covered").alias("score"))
    seen = merged.select("doc_id", "h", none.cast("struct<label string, at int, covered double, end int>").alias("s"), F.col("covered").alias("score"))
    s, base, notice = F.col("s"), F.col("s").isNotNull() & F.col("s.covered").isNull(), F.col("s.covered").isNotNull()
    by_doc = exact.union(won).union(seen).groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).agg(
        F.sum(F.when(base, 1)).alias("n_base"), F.min(F.when(base, s["at"])).cast("long").alias("first_word"), F.max(F.when(base, s["at"])).cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(base, s["label"]))).alias("own"), F.array_sort(F.collect_set(s["label"])).alias("every"),
        F.max("score").alias("score"), F.collect_list(F.when(notice, s)).alias("spans"),
    )
    by_doc = tables.keep(tables.stored(by_doc, "license-documents"))
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sizes, "doc_id long, h long, n_words long")
    df = sizes.join(tables.small(by_doc, SMALL_HITS), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    text = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return df.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word", text("own").alias("base_labels"), text("every").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("spans", F.array().cast("array<struct<label string, at int, covered double, end int>>")).alias("spans"))
