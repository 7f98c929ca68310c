"""License scan by diagonal voting over rolling hashes of word k-grams.

The k-grams of a text and of the license templates share one rolling hash. Spark joins all
k-gram hashes of all texts to the positions of the templates, a table bounded by the
templates; the other side stays where it is. Each hit votes for a diagonal, the place of
the k-gram in the text less its place in the template. Diagonals that lie within the length
of a template (``REACH`` words at most), as they arise around inserted and dropped words, are
merged, and the span of the text they point at is verified against the template word by word.

Short templates vote with pairs of words and the others with triples. A span is verified if
a fifth of the template's k-grams vote for it. So a passage that lacks up to a fifth of its
words is always verified, and one with words put in at a few places is as well.

Labels come from two sources: phrases, found wherever their words stand consecutively,
and spans whose score, the share of the template that the span holds in order, reaches
``MIN_SCORE``. Of spans that lie over each other only the best gives a label, of equal scores
the one with more words, so that a license is not taken for its near relations.

Null and empty texts have no words, no label and the score 0. A text is known by its id (a
null id too) and a hash; repeated rows get equal results, and rows that share an id but not
the text each get their own. An empty table gives an empty table; extra columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableforge.llm.common import documents, whole_text, written

GRAMS = (2, 3)
#: Templates below this many words vote with pairs of words.
SHORT = 12
MIN_SCORE = 0.8
#: Diagonals this near are counted as one.
NEAR = 4
#: Diagonals of one span are this near at most, and not farther than the template is long.
REACH = 32
CACHE_WORDS = 300_000
#: Factor of the rolling hash, modulo 2 to the 64.
FACTOR = 0x9E3779B97F4A7C15

#: Phrases and the labels they give (fixed values).
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Passages of well-known licenses and the labels they give (fixed values).
TEMPLATES = {
    "agpl": "This program is free software you can redistribute it and or modify it under the terms "
    "of the GNU Affero General Public License as published by the Free Software Foundation",
    "apache-2.0": "Licensed under the Apache License Version 2.0 the License you may not use this file "
    "except in compliance with the License",
    "apache-2.0-short": "Licensed under the Apache License Version 2.0",
    "apache-2.0-warranty": "Unless required by applicable law or agreed to in writing software distributed "
    "under the License is distributed on an AS IS BASIS WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND "
    "either express or implied",
    "bsd": "Redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission",
    "bsl-1.0": "Distributed under the Boost Software License Version 1.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc": "Licensed under CC BY NC 4.0",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 "
    "International License",
    "cc0-1.0": "To the extent possible under law the author has waived all copyright and related or "
    "neighboring rights to this work",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the "
    "Eclipse Public License 2.0",
    "gfdl": "Permission is granted to copy distribute and or modify this document under the terms of the "
    "GNU Free Documentation License",
    "gpl-3.0": "This work is licensed under the GNU General Public License version 3",
    "gpl-program": "This program is free software you can redistribute it and or modify it under the "
    "terms of the GNU General Public License as published by the Free Software Foundation",
    "isc": "Permission to use copy modify and or distribute this software for any purpose with or "
    "without fee is hereby granted",
    "isc-notice": "provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl": "This library is free software you can redistribute it and or modify it under the terms of "
    "the GNU Lesser General Public License as published by the Free Software Foundation",
    "mit": "Permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the Software to deal in the Software without restriction",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software",
    "mit-short": "Released under the MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License v 2.0",
    "mpl-2.0-copy": "If a copy of the MPL was not distributed with this file You can obtain one at",
    "ofl-1.1": "This Font Software is licensed under the SIL Open Font License Version 1.1",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "unlicense-use": "Anyone is free to copy modify publish use compile sell or distribute this software "
    "either in source code form or as a compiled binary for any purpose commercial or non commercial "
    "and by any means",
    "wtfpl": "Everyone is permitted to copy and distribute verbatim or modified copies of this license "
    "document and changing it is allowed as long as the name is changed",
    "zlib": "Permission is granted to anyone to use this software for any purpose including commercial "
    "applications and to alter it and redistribute it freely subject to the following restrictions",
}
LABELS = {
    "apache-2.0-short": "apache-2.0",
    "apache-2.0-warranty": "apache-2.0",
    "bsd-names": "bsd",
    "cc-by-4.0": "cc-by",
    "gpl-program": "gpl",
    "isc-notice": "isc",
    "mit-notice": "mit",
    "mit-short": "mit",
    "mpl-2.0-copy": "mpl-2.0",
    "unlicense-use": "unlicense",
}

#: Bytes that are no part of a word: ASCII but letters and digits.
_GAPS = bytes(
    byte if byte >= 128 or chr(byte).isalnum() else 32 for byte in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_GAPS).split()


def rolling_hashes(numbers: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive words, given a hash of each word."""
    if len(numbers) < size:
        return numbers[:0]
    total = np.zeros(len(numbers) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = total * np.uint64(FACTOR) + numbers[k : len(numbers) - size + 1 + k]
    return total


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


@cache
def template_words(name: str) -> tuple[bytes, ...]:
    return tuple(words_of(TEMPLATES[name].encode()))


def gram_size(name: str) -> int:
    return GRAMS[len(template_words(name)) >= SHORT]


def template_positions(spark: SparkSession) -> DataFrame:
    """A row for each k-gram of each template, with how many the template has: some hundreds."""
    rows = []
    for name in TEMPLATES:
        numbers = np.array([word_hash(word) for word in template_words(name)], np.uint64)
        grams = rolling_hashes(numbers, gram_size(name)).view(np.int64).tolist()
        rows += [(gram, name, at, len(grams), len(numbers)) for at, gram in enumerate(grams)]
    return spark.createDataFrame(rows, "gram long, template string, place int, n_grams int, n_words int")


def phrase_places(words: list[bytes]) -> tuple[int, int | None, int | None, list[str]]:
    """Number of places of all phrases, smallest and largest start, and labels."""
    line = b" " + b" ".join(words) + b" "
    starts, labels = [], []
    for phrase, label in PHRASES.items():
        key = f" {phrase} ".encode()
        at = line.find(key)
        if at >= 0:
            labels.append(label)
        while at >= 0:
            starts.append(line.count(b" ", 0, at))
            at = line.find(key, at + 1)
    if not starts:
        return 0, None, None, []
    return len(starts), min(starts), max(starts), sorted(labels)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document, hash of its text, and the hashes of the pair and the triple that begin at each word."""
    known: dict[bytes, int] = {}

    def learn(word: bytes) -> int:
        if len(known) >= CACHE_WORDS:
            known.clear()
        known[word] = found = word_hash(word)
        return found

    for batch in batches:
        grams, ends = [np.zeros(0, np.uint64)], [0]
        for text in batch.column(2).cast(pa.binary()).to_pylist():
            numbers = np.array([known.get(word) or learn(word) for word in words_of(text)], np.uint64)
            both = np.zeros((len(numbers), len(GRAMS)), np.uint64)  # 0 where a text ends
            for k, size in enumerate(GRAMS):
                found = rolling_hashes(numbers, size)
                both[: len(found), k] = found
            grams.append(both.ravel())
            ends.append(ends[-1] + both.size)
        flat = pa.array(np.concatenate(grams).view(np.int64))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["doc_id", "text_hash", "grams"])


@cache
def _word_bits(name: str) -> dict[bytes, int]:
    """For each word of a template a number with the bits of its places."""
    bits: dict[bytes, int] = {}
    for at, word in enumerate(template_words(name)):
        bits[word] = bits.get(word, 0) | 1 << at
    return bits


def words_in_order(words: list[bytes], template: str) -> int:
    """Length of the longest common subsequence, a bit for each word of the template."""
    bits, size = _word_bits(template), len(template_words(template))
    rest = whole = (1 << size) - 1
    for word in words:
        at = bits.get(word)
        if at:
            hit = rest & at
            rest = (rest + hit | rest - hit) & whole
    return size - rest.bit_count()


def best_spans(words: list[bytes], spans: list[dict]) -> tuple[set[str], float]:
    """Labels of the spans that reach ``MIN_SCORE`` and lie under no better one, and the best score."""
    found, top = [], 0.0
    for span in spans:
        name = span["template"]
        size = len(template_words(name))
        start, stop = max(0, span["low"] - NEAR), span["high"] + size + NEAR
        common = words_in_order(words[start:stop], name)
        top = max(top, common / size)
        if common / size >= MIN_SCORE:
            found.append((-common / size, -common, max(0, span["low"]), span["high"] + size, name))
    labels, taken = set(), []
    for _, _, start, stop, name in sorted(found):
        # Over half of the shorter one is over each other, so that neighbours are not.
        if all(2 * (min(stop, e) - max(start, b)) <= min(stop - start, e - b) for b, e in taken):
            labels.add(LABELS.get(name, name))
            taken.append((start, stop))
    return labels, top


RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double"
)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of each text, and the licenses whose spans are verified."""
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(
            batch.column(0).to_pylist(),
            batch.column(1).cast(pa.binary()).to_pylist(),
            batch.column(2).to_pylist(),
            strict=True,
        ):
            words = words_of(text)
            count, first, last, base = phrase_places(words)
            found, top = best_spans(words, spans or [])
            labels = ",".join(sorted(found.union(base)))
            score = max(1.0 if base else 0.0, top)
            rows.append((doc_id, len(words), count, first, last, ",".join(base), labels, score))
        kinds = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.float64()]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
            [part.split()[0] for part in RESULT.split(", ")],
        )


def candidate_spans(texts: DataFrame) -> DataFrame:
    """``doc_id, text_hash, template, low, high``: merged diagonals with enough votes.

    Diagonals fall into cells of ``NEAR``, and votes are added up by cell before the shuffle.
    From each cell on, those in reach are one span. The number of spans of a text is bounded
    by its length over ``NEAR`` for each template.
    """
    places = template_positions(texts.sparkSession)
    grams = texts.mapInArrow(_grams, "doc_id long, text_hash long, grams array<long>")
    grams = grams.select("doc_id", "text_hash", F.posexplode("grams").alias("at", "gram"))
    hits = grams.join(F.broadcast(places), "gram")  # bounded by TEMPLATES
    diagonal = F.floor(F.col("at") / len(GRAMS)) - F.col("place")
    key = ["doc_id", "text_hash", "template"]
    cells = hits.groupBy(*key, "n_grams", "n_words", F.floor(diagonal / NEAR).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, place % 64)")).alias("places"),
        F.min(diagonal).alias("low"),
        F.max(diagonal).alias("high"),
    )
    # In units of the reach, so that one frame serves templates of every length.
    along = F.col("cell") * float(NEAR) / F.least("n_words", F.lit(REACH))
    ahead = Window.partitionBy(*key).orderBy(along).rangeBetween(0, 1)
    merged = cells.select(
        *key, "n_grams", "low", F.max("high").over(ahead).alias("high"), F.bit_or("places").over(ahead).alias("places")
    )
    # A span that holds most of a template has a good part of its k-grams as well.
    enough = 5 * F.bit_count("places") >= F.least("n_grams", F.lit(64))
    return merged.where(enough).select(*key, "low", "high")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """A row for each document with the phrases and licenses found in its whole text."""
    text = whole_text(F.col("text"))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    spans = candidate_spans(texts).groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("template", "low", "high")).alias("spans")
    )
    spans = written(spans, "spans").select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "spans")
    found = texts.join(
        spans, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash")), "left"
    )
    return found.select("doc_id", "text", "spans").mapInArrow(_judge, RESULT)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))
