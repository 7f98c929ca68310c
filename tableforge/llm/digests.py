"""Document fingerprints of improbable features in chained Bloom filters.

Every window of ``WINDOW`` bytes has an entropy; the less probable it is for text, the
lower the rank of the window. Of each ``NEIGHBOURS`` neighbouring windows the first of lowest
rank gets a point, and windows with ``MIN_POINTS`` are the features of the text. Neighbours
reach beyond both ends of the text, so the rule is the same for short and long texts. A feature
sets ``BITS`` bits of a Bloom filter; a filter takes ``PER_FILTER`` features, then the next
one is begun. Two digests are as like as the filters of the shorter one to the best match
among those of the other, by common bits above what chance gives, from 0 to 1.

How probable an entropy is follows from a rule with two parameters, not from the corpus, so
digests of different tables compare. A text in which no window qualifies has one feature,
the whole text; the empty text has none, is like itself and nothing else.

A document's successor is the next smaller id; after the smallest comes the largest. The
documents are dealt into ranges of ids and text hashes, and each range gets a copy of the one
document that follows it, so texts are shuffled once. Rows that share an id follow each other
by text, so an id (or the null id) with many rows is dealt over many ranges, and so are equal
rows, which may change places. Null texts are empty. A null id comes last. With one row, it
follows itself. An empty table gives an empty table; extra columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.llm.common import documents, whole_text, written

WINDOW = 16
NEIGHBOURS = 16
MIN_POINTS = 4
BITS = 5
FILTER_BITS = 2048
PER_FILTER = 160
#: Entropy, in bits a byte, that windows of prose have, and its spread.
USUAL_ENTROPY = 3.1
SPREAD = 0.25
#: Share of the way from chance to all bits in common that counts as chance.
CHANCE = 0.1

_FILTER_BYTES = FILTER_BITS // 8
#: Steps in which entropies are counted: sums of whole numbers are the same everywhere.
_STEPS = 1 << 16
#: Longest window whose entropy is counted.
_LONGEST = 64
_COUNTS = np.arange(_LONGEST + 2)
_LOGS = np.round(_STEPS * _COUNTS * np.log2(np.maximum(_COUNTS, 1))).astype(np.int64)


def window_entropies(data: np.ndarray, window: int = _LONGEST) -> np.ndarray:
    """Entropy of each run of ``window`` bytes of ``data``, in one pass of array operations.

    Between neighbouring windows one byte goes and one comes, so the entropy changes by
    terms of how often these two are in the window; equal bytes are found by sorting.
    """
    count = len(data) - window + 1
    if count <= 0:
        return np.zeros(0)
    order = np.argsort(data, kind="stable")
    # One number line: the places of a byte, far from the places of the next byte.
    keys = data[order].astype(np.int64) * (2 * len(data) + 2 * window) + order
    upto = np.searchsorted(keys, keys + window)
    rank = np.arange(len(data))
    ahead = np.empty(len(data), np.int64)
    ahead[order] = upto - rank  # of this byte, from here to the end of the window
    back = np.empty(len(data), np.int64)
    back[order] = rank - np.searchsorted(keys, keys - window, side="right") + 1
    first = np.bincount(data[:window], minlength=1)
    total = np.empty(count, np.int64)
    total[0] = _LOGS[first].sum()
    gone, come = ahead[: count - 1], back[window:]
    # Going takes its byte from n to n - 1 in a window that still lacks the byte to come.
    same = data[: count - 1] == data[window:]
    change = _LOGS[gone - 1] - _LOGS[gone] + _LOGS[come] - _LOGS[come - 1]
    total[1:] = total[0] + np.cumsum(np.where(same, 0, change))
    return np.log2(window) - total / (window * _STEPS)


def feature_places(data: np.ndarray) -> np.ndarray:
    """First bytes of the windows that are features."""
    entropy = window_entropies(data, WINDOW)
    if not len(entropy):
        return np.zeros(0, np.int64)
    # Far from the usual entropy is improbable; too little of it says nothing.
    odd = np.minimum(np.abs(entropy - USUAL_ENTROPY) / SPREAD, 15.0)
    rank = 1000 - np.round(odd * 60).astype(np.int64)
    rank[entropy < 1.0] = 1001
    key = rank << 32 | np.arange(len(rank))
    # Neighbours beyond the ends never win, so that the windows near an end get points too.
    beyond = np.full(NEIGHBOURS - 1, np.iinfo(np.int64).max)
    low, width = np.concatenate([beyond, key, beyond]), 1
    while width < NEIGHBOURS:
        step = min(width, NEIGHBOURS - width)
        low = np.minimum(low[: len(low) - step], low[step:])
        width += step
    places, points = np.unique(low & 0xFFFFFFFF, return_counts=True)
    return places[(points >= MIN_POINTS) & (rank[places] <= 1000)]


def digest(text: bytes, places: np.ndarray | None = None) -> bytes:
    """Chained filters of the features of ``text``, one after the other."""
    if not text:
        return b""
    if places is None:
        places = feature_places(np.frombuffer(text, np.uint8))
    parts = [text[at : at + WINDOW] for at in places.tolist()] or [text]
    hashes = list(dict.fromkeys([hashlib.sha1(part).digest() for part in parts]))
    words = np.frombuffer(b"".join(hashes), ">u4").reshape(-1, 5)
    bits = (words & (FILTER_BITS - 1)).astype(np.int64)
    chain = np.arange(len(hashes)) // PER_FILTER
    filters = np.zeros((int(chain[-1]) + 1, FILTER_BITS), bool)
    filters[np.repeat(chain, BITS), bits.ravel()] = True
    return np.packbits(filters, axis=1).tobytes()


def likeness(one: bytes, other: bytes) -> float:
    """Mean, over the filters of the shorter digest, of the best match in the other.

    Of equally long digests each is held against the other, and the two means are averaged.
    """
    if one == other:
        return 1.0
    if not one or not other:
        return 0.0
    a, b = (
        np.frombuffer(part, np.uint64).reshape(-1, _FILTER_BYTES // 8)
        for part in sorted((one, other), key=len)
    )
    if 1 < len(a) == len(b):
        return (_best_matches(a, b) + _best_matches(b, a)) / 2
    return _best_matches(a, b)


def _best_matches(a: np.ndarray, b: np.ndarray) -> float:
    size_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    scores = []
    for row in a:  # a row at a time: the filters of two long texts are many pairs
        size = int(np.bitwise_count(row).sum())
        common = np.bitwise_count(row & b).sum(axis=1, dtype=np.int64)
        most = np.minimum(size, size_b)
        chance = size * size_b / FILTER_BITS
        floor = chance + CHANCE * (most - chance)
        scores.append(np.max(np.where(common > floor, (common - floor) / np.maximum(most - floor, 1e-9), 0.0)))
    return float(min(1.0, np.mean(scores)))


def edited(text: str, following: str) -> str:
    """``text`` whose last third is replaced by the beginning of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def edited_places(data: bytes, places: np.ndarray, text: bytes, same: int) -> np.ndarray:
    """Features of an edited text, of which the first ``same`` bytes are those of ``text``.

    Whether a window is a feature is settled by ``NEIGHBOURS`` windows on each side, so the
    features before the edit are known, and only the rest is looked at.
    """
    known = same - WINDOW - NEIGHBOURS
    begin = known - NEIGHBOURS
    if begin < NEIGHBOURS:
        return feature_places(np.frombuffer(data, np.uint8))
    rest = feature_places(np.frombuffer(data[begin:], np.uint8)) + begin
    return np.concatenate([places[places < known], rest[rest >= known]])


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


class _Fingerprinted:
    """A text, the features in it and its digest."""

    def __init__(self, text: str):
        self.text, self.data = text, text.encode()
        self.places = feature_places(np.frombuffer(self.data, np.uint8)) if self.data else np.zeros(0, np.int64)
        self.digest = digest(self.data, self.places)


def _row(doc_id: int | None, this: _Fingerprinted, following: _Fingerprinted) -> tuple:
    changed = edited(this.text, following.text)
    data = changed.encode()
    same = len(this.text[: len(this.text) - len(this.text) // 3].encode())
    other = digest(data, edited_places(data, this.places, this.data, same) if data else None)
    return (
        doc_id,
        len(this.text),
        hashlib.sha256(data).hexdigest(),
        base64.b64encode(this.digest).decode(),
        base64.b64encode(other).decode(),
        likeness(this.digest, other),
        likeness(this.digest, following.digest),
    )


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (range, borrowed, doc_id, text) in order of range and falling id."""
    last = None
    names = [part.split()[0] for part in RESULT.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    for batch in batches:
        rows = []
        parts, borrowed, ids = (batch.column(k).to_pylist() for k in range(3))
        texts = batch.column(3)
        for k, part in enumerate(parts):
            now = _Fingerprinted(texts[k].as_py())
            if last is not None and last[0] == part:
                rows.append(_row(last[1], last[2], now))
            last = None if borrowed[k] else (part, ids[k], now)
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names
        )


@dataclass(frozen=True)
class RangeHeads:
    """The first keys of the ranges, in the order of the documents: falling id, nulls last, hash.

    ``falling`` are the inverted ids of the first ``len(falling)`` heads; the others have null
    ids. ``hashes`` are those of all heads. Equal heads are those of rows that are equal.
    """

    falling: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, keys: DataFrame, ranges: int) -> RangeHeads:
        """From a sort of ids and hashes into ranges; a row of each range comes to the driver."""
        tie = F.monotonically_increasing_id()  # parts rows that are equal
        dealt = keys.repartitionByRange(ranges, F.col("doc_id").desc_nulls_last(), "text_hash", tie)
        order = F.struct(F.col("doc_id").isNull(), F.bitwise_not(F.col("doc_id")), F.col("text_hash"))
        parts = dealt.select(F.spark_partition_id().alias("part"), order.alias("key"))
        heads = sorted(
            (no_id, falling or 0, text_hash)
            for no_id, falling, text_hash in (
                row["head"] for row in parts.groupBy("part").agg(F.min("key").alias("head")).collect()
            )
        )
        return cls(
            np.array([head[1] for head in heads if not head[0]], np.int64),
            np.array([head[2] for head in heads], np.int64),
        )

    def __len__(self) -> int:
        return len(self.hashes)

    def key(self, k: int) -> tuple[int | None, int]:
        """Id and hash of the first row of range ``k``."""
        doc_id = ~int(self.falling[k]) if k < len(self.falling) else None
        return doc_id, int(self.hashes[k])

    def find(self, ids: np.ndarray, no_id: np.ndarray, hashes: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Range of each row, by binary search; rows equal to several heads are dealt over them."""
        falling = np.where(no_id, 0, ~ids)
        low = np.where(no_id, len(self.falling), np.searchsorted(self.falling, falling, "left"))
        high = np.where(no_id, len(self), np.searchsorted(self.falling, falling, "right"))
        begin, end = low.copy(), low.copy()
        # Only rows of an id that some head has look at hashes as well.
        near = np.flatnonzero(low < high)
        for first in np.unique(low[near]):
            rows = near[low[near] == first]
            heads = self.hashes[first : high[rows[0]]]
            begin[rows] = first + np.searchsorted(heads, hashes[rows], "left")
            end[rows] = first + np.searchsorted(heads, hashes[rows], "right")
        equal = end - begin
        dealt = begin + ties % np.maximum(equal, 1)
        return np.where(equal > 0, dealt, np.maximum(begin - 1, 0))

    def part(self, doc_id: Column, text_hash: Column) -> Column:
        def found(ids: pd.Series, no_id: pd.Series, hashes: pd.Series, ties: pd.Series) -> pd.Series:
            columns = (column.to_numpy() for column in (ids, no_id, hashes, ties))
            return pd.Series(self.find(*columns), dtype="int32")

        search = F.pandas_udf(found, "int")
        return search(F.coalesce(doc_id, F.lit(0)), doc_id.isNull(), text_hash, F.monotonically_increasing_id())


def with_successors(texts: DataFrame) -> DataFrame:
    """``part, borrowed, doc_id, text``: ranges in order, each with the row that follows it.

    The order is falling ``doc_id``, nulls last, then the text's hash. Ids and hashes are
    written once, and sorted into ranges; the texts find theirs by the ranges' first keys.
    """
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    # Several ranges for each task, so that tasks get like amounts.
    heads = RangeHeads.of(written(rows.select("doc_id", "text_hash"), "keys"), 4 * parts)
    if not len(heads):
        return rows.select(F.lit(0).alias("part"), F.lit(False).alias("borrowed"), "doc_id", "text")
    lent: dict[tuple[int | None, int], list[int]] = {}
    for k in range(len(heads)):
        lent.setdefault(heads.key((k + 1) % len(heads)), []).append(k)
    firsts = spark.createDataFrame(
        [(doc_id, text_hash, to) for (doc_id, text_hash), to in lent.items()], "id long, hash long, to array<int>"
    )
    copies = rows.join(
        F.broadcast(firsts),  # at most a row for each range
        (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id")),
    ).dropDuplicates(["doc_id", "text_hash"])
    copies = copies.select(F.explode("to").alias("part"), F.lit(True).alias("borrowed"), "doc_id", "text", "text_hash")
    part = heads.part(F.col("doc_id"), F.col("text_hash"))
    own = rows.select(part.alias("part"), F.lit(False).alias("borrowed"), "doc_id", "text", "text_hash")
    dealt = own.union(copies).repartition(parts, "part")
    ordered = dealt.sortWithinPartitions("part", "borrowed", F.col("doc_id").desc_nulls_last(), "text_hash")
    return ordered.select("part", "borrowed", "doc_id", "text")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Digests of each document and of its edited text, and how like they are."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    return with_successors(texts).mapInArrow(_results, RESULT)


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))
