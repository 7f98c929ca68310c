"""SimHash near-duplicates by a hierarchical index over fingerprints in Gray order.

A fingerprint is the bitwise majority over the hashes of all word shingles of a text. Two
texts are linked if their fingerprints differ in ``MAX_BITS`` bits or fewer.

The upper level of the index is a set of masks: four blocks of the bits, and in the rest
four blocks again, so that two fingerprints that near agree on all bits of at least one
of the sixteen masks, and groups that differ under every mask are pruned unseen. The
fingerprints under one masked pattern are sorted by Gray rank, where neighbours differ in
few bits. A large group is cut into leaves whose nodes hold the bits all members share,
up to a root; two nodes that differ in too many shared bits are pruned with all below
them. A group above ``MAX_GROUP`` is dealt out anew under masks of more bits, which loses
no link; under the longest masks 2 to the 15 fingerprints at most are left in a group.

A group sends on links that join its parts, never all its pairs, and equal fingerprints
are one node from the start. Null texts have no words and the fingerprint zero, which is
linked like any other. A null ``doc_id`` never names a component unless no other id is in
it. Rows with the same id are fingerprinted each by its own text. Ties and repeated rows
fall into one component. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tableforge.llm.common import documents, fresh_name, whole_text, written
from tableforge.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
MAX_GROUP = 1 << 15
LEAF = 64
FANOUT = 8
ALL_BITS = (1 << 64) - 1


def fingerprint(text: bytes) -> int:
    """Majority of each bit over the shingles of a text in UTF-8."""
    words = text.lower().split()  # of bytes: A-Z alone, and ASCII white space alone
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))
    digests = b"".join([xxhash.xxh64_digest(shingle, SEED) for shingle in shingles])
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(rows), 1 << 14):
        counts += np.unpackbits(rows[at : at + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(rows)).tobytes(), "big")


@F.arrow_udf(LongType())
def fingerprints(texts: pa.Array) -> pa.Array:
    found = [fingerprint(text) for text in texts.cast(pa.binary()).to_pylist()]
    return pa.array(np.array(found, np.uint64).view(np.int64))


def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def refined(mask: int) -> list[int]:
    """``mask`` with one of the blocks added into which its free bits fall."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    blocks = np.array_split(np.array(free), MAX_BITS + 1)
    return [mask | sum(1 << int(bit) for bit in block) for block in blocks]


def gray_rank(value: Column) -> Column:
    """Place of a fingerprint in Gray order: the exclusive or of all its prefixes."""
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value


def _under(rows: DataFrame, masks: list[int]) -> DataFrame:
    """Each fingerprint under each of ``masks``."""
    kinds = F.explode(F.array(*[F.lit(signed(mask)) for mask in masks]))
    keyed = rows.select("fp", kinds.alias("mask"))
    return keyed.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("pattern"), "fp")


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give each of the linked parts of ``label`` its least label."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(label[label], label):
            label[:] = label[label]


class _Parts:
    """Members of sorted groups, the parts they are joined to, and the links that did it."""

    def __init__(self, fps: np.ndarray):
        self.fps, self.label = fps, np.arange(len(fps))
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def try_pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.label[a] != self.label[b]
        a, b = a[apart], b[apart]
        near = np.bitwise_count(self.fps[a] ^ self.fps[b]) <= MAX_BITS
        a, b = a[near], b[near]
        if len(a):
            # One link for each pair of parts is enough.
            pairs = np.stack([self.label[a], self.label[b]], axis=1)
            _, first = np.unique(pairs, axis=0, return_index=True)
            a, b = a[first], b[first]
            self.links.append((self.fps[a], self.fps[b]))
            _merge(self.label, a, b)


def _levels(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shared bits and their pattern of each node, from the leaves up."""
    both = np.bitwise_and.reduceat(fps, np.arange(0, len(fps), LEAF))
    some = np.bitwise_or.reduceat(fps, np.arange(0, len(fps), LEAF))
    levels = [(~(both ^ some), both)]
    while len(both) > 1:
        starts = np.arange(0, len(both), FANOUT)
        both, some = np.bitwise_and.reduceat(both, starts), np.bitwise_or.reduceat(some, starts)
        levels.append((~(both ^ some), both))
    return levels


def _search(parts: _Parts, start: int, stop: int) -> None:
    """Link the members of one large group through the nodes above them."""
    fps = parts.fps[start:stop]
    levels = _levels(fps)
    a = b = np.zeros(1, np.int64)
    step = np.arange(FANOUT)
    for below in range(len(levels) - 2, -1, -1):
        shared, pattern = levels[below]
        a, b = (
            np.repeat(a * FANOUT, FANOUT * FANOUT) + np.tile(np.repeat(step, FANOUT), len(a)),
            np.repeat(b * FANOUT, FANOUT * FANOUT) + np.tile(np.tile(step, FANOUT), len(b)),
        )
        inside = (a <= b) & (b < len(shared))
        a, b = a[inside], b[inside]
        differ = np.bitwise_count((pattern[a] ^ pattern[b]) & shared[a] & shared[b])
        a, b = a[differ <= MAX_BITS], b[differ <= MAX_BITS]
    order = np.argsort(b - a, kind="stable")  # near ones first: later pairs are then joined
    a, b = a[order], b[order]
    leaf = np.arange(LEAF)
    for at in range(0, len(a), 64):
        left = (a[at : at + 64, None, None] * LEAF + leaf[None, :, None]) + np.zeros_like(leaf)
        right = (b[at : at + 64, None, None] * LEAF + leaf[None, None, :]) + np.zeros_like(leaf)[:, None]
        left, right = left.ravel(), right.ravel()
        inside = (left < right) & (right < len(fps))
        parts.try_pairs(left[inside] + start, right[inside] + start)


def links_in_groups(fps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the members of each group; ``starts`` has the groups' first places."""
    parts = _Parts(fps)
    ends = np.append(starts[1:], len(fps))
    sizes = ends - starts
    group_end = np.repeat(ends, sizes)
    rows = np.arange(len(fps))
    small = np.repeat(sizes <= LEAF, sizes)
    rows = rows[small]
    lag = 1
    while len(rows := rows[rows + lag < group_end[rows]]):
        parts.try_pairs(rows, rows + lag)
        lag += 1
    for start, stop in zip(starts[sizes > LEAF], ends[sizes > LEAF], strict=True):
        parts.try_pairs(np.arange(start, stop - 1), np.arange(start + 1, stop))
        _search(parts, start, stop)
    if not parts.links:
        return fps[:0], fps[:0]
    return tuple(np.concatenate(side) for side in zip(*parts.links, strict=True))


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links in a stream of rows sorted by mask and pattern, then by Gray rank."""
    rest = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        if rest is not None:
            columns = [np.concatenate(pair) for pair in zip(rest, columns, strict=True)]
        rest = columns
        mask, pattern, fps = columns
        if not len(fps):
            continue
        new = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])) + 1
        if len(new):  # the last group may go on in the next batch
            rest = [column[new[-1] :] for column in columns]
            yield _found(fps[: new[-1]], np.append(0, new[:-1]))
    if rest is not None and len(rest[2]):
        yield _found(rest[2], np.zeros(1, np.int64))


def _found(fps: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    u, v = links_in_groups(fps.view(np.uint64), starts)
    columns = [pa.array(np.ascontiguousarray(side).view(np.int64)) for side in (u, v)]
    return pa.RecordBatch.from_arrays(columns, ["u", "v"])


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links ``u, v`` that join all fingerprints (column ``fp``, distinct) that are near."""
    masks = [deep for mask in refined(0) for deep in refined(mask)]
    rows = _under(fps, masks)
    found = None
    while True:
        last = bin(masks[0]).count("1") >= 49
        plain = rows
        if not last:
            sizes = rows.groupBy("mask", "pattern").count()
            large = written(sizes.where(F.col("count") > MAX_GROUP).drop("count"), "large")
            hot = not large.isEmpty()
            if hot:
                plain = rows.join(large, ["mask", "pattern"], "left_anti")
        dealt = plain.repartition("mask", "pattern").sortWithinPartitions(
            "mask", "pattern", gray_rank(F.col("fp"))
        )
        links = dealt.select("mask", "pattern", "fp").mapInArrow(_links, "u long, v long")
        found = links if found is None else found.union(links)
        if last or not hot:
            return found
        deeper = F.create_map(
            *[
                item
                for mask in masks
                for item in (
                    F.lit(signed(mask)),
                    F.array(*[F.lit(signed(deep)) for deep in refined(mask)]),
                )
            ]
        )
        rows = rows.join(large, ["mask", "pattern"]).select("fp", F.explode(deeper[F.col("mask")]).alias("mask"))
        # Blocks added in another order may give the same mask.
        rows = rows.distinct().select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("pattern"), "fp")
        masks = list(dict.fromkeys(deep for mask in masks for deep in refined(mask)))


def component_names(marked: DataFrame) -> DataFrame:
    """``fp, component_id`` for each fingerprint in the columns ``doc_id, fp`` of ``marked``."""
    ids = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(fingerprint_links(ids.select("fp"))).withColumnRenamed("node", "fp")
    joined = ids.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.join(heads, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``fingerprint`` and ``component_id``.

    Both columns take the place of columns of ``docs`` with these names.
    """
    keep = [name for name in keep if name.lower() not in ("fingerprint", "component_id")]
    fp = fresh_name(keep, "fp")
    marked = docs.select(*keep, fingerprints(whole_text(F.col("text"))).alias(fp))
    marked = written(marked, "fingerprints")
    names = component_names(marked.select("doc_id", F.col(fp).alias("fp")))
    names = names.withColumnRenamed("fp", "__fp")
    named = marked.join(names, F.col(fp) == F.col("__fp"), "left")
    shown = F.lower(F.lpad(F.hex(fp), 16, "0")).alias("fingerprint")
    return named.select(*keep, shown, "component_id")


def keep_representatives(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest ``doc_id``.

    Rows of equal text that share this id are one document and stay.
    """
    fp = fresh_name(docs.columns, "fp")
    marked = docs.select("*", fingerprints(whole_text(F.col("text"))).alias(fp))
    marked = written(marked, "marked")
    rows = marked.select("doc_id", F.col(fp).alias("fp"))
    names = component_names(rows)
    first = rows.join(names, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.select(F.col("doc_id").alias("__doc"), F.col("fp").alias("__fp")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col(fp) == F.col("__fp"))
    return marked.join(first, same, "left_semi").drop(fp)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), ["doc_id"])
