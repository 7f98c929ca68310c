"""Ranked lexical search with range-maximum tables over posting lists.

Documents are cut into chunks of bounded size. A chunk has the posting lists of the terms
that are asked for: places of documents in the chunk, with the impact of the term on each.
A sparse table over each list gives the largest impact in any interval of documents. For an
item, the sum of these over its terms bounds the score of every document of an interval.
Intervals are taken up best first, the one with the highest bound before all others: the
document of the largest single impact in it is scored exactly, and what lies before and
after it become intervals of their own. The search ends where no bound reaches the last of the best
scores so far. These are kept over all chunks of a task, so later chunks are cut off earlier.

Each text is read once for a block of items of bounded size. Chunks are written, so the
counts over all documents (their number, their length, documents by term) come from them, and
nothing is shuffled but counts by term and the best rows of each task.

A null or empty text has no terms, and no score. Documents with equal ids are documents of
their own, each with a rank; null ids come last among equal scores. Rows of ``items`` with
the same id (or with none) are one item with the terms of all; an item without terms, or
without a document, has no rows. Empty tables give an empty table. Only the columns ``doc_id``
and ``text`` of documents and ``item_id`` and ``text`` of items are looked at.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableforge.llm.common import documents, whole_text, written

TOP = 50
#: A chunk is full from so many postings or documents on; one text adds less than its terms.
CHUNK_POSTINGS = 1 << 19
CHUNK_DOCUMENTS = 1 << 16
#: Terms of the items that are sent to all tasks at once, on average.
BLOCK_TERMS = 100_000
#: Intervals that are split at once, at most.
TOGETHER = 256
NO_ID = np.iinfo(np.int64).max

#: Letters, digits and all bytes of other characters stay, A-Z in lower case; the rest separates.
LETTERS = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or chr(byte).isalnum() else 32 for byte in range(256)
)

CHUNKS = (
    "documents long, terms long, ids binary, lengths binary, "
    "list_terms binary, list_starts binary, places binary, counts binary"
)
HITS = "item int, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, terms = [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            found = set(terms_of(text))
            ids.extend([item] * len(found))
            terms.extend(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(terms, pa.binary()).cast(pa.string())], ["item_id", "term"]
        )


@dataclass
class _Chunk:
    """Documents with terms that are asked for, while a chunk fills up."""

    documents: int = 0
    terms: int = 0
    ids: list = field(default_factory=list)
    lengths: list = field(default_factory=list)
    postings: tuple[array, array, array] = field(default_factory=lambda: (array("i"), array("i"), array("i")))

    def add(self, doc_id: int | None, words: list[bytes], numbers: dict[bytes, int]) -> None:
        if not words:
            return
        self.documents += 1
        self.terms += len(words)
        counts = Counter(words)
        hits = counts.keys() & numbers.keys()
        if hits:
            place = len(self.ids)
            self.ids.append(NO_ID if doc_id is None else doc_id)
            self.lengths.append(len(words))
            terms, places, often = self.postings
            terms.extend([numbers[term] for term in hits])
            places.extend([place] * len(hits))
            often.extend([counts[term] for term in hits])

    def full(self) -> bool:
        return len(self.postings[0]) >= CHUNK_POSTINGS or len(self.ids) >= CHUNK_DOCUMENTS

    def packed(self) -> pa.RecordBatch:
        numbers, places, often = (np.array(column, np.int32) for column in self.postings)
        by_term = np.argsort(numbers, kind="stable")  # places come in order
        terms, starts = np.unique(numbers[by_term], return_index=True)
        parts = [
            np.array(self.ids, np.int64),
            np.array(self.lengths, np.int64),
            terms,
            np.append(starts, len(numbers)).astype(np.int32),
            places[by_term],
            often[by_term],
        ]
        columns = [pa.array([self.documents]), pa.array([self.terms])]
        columns += [pa.array([part.tobytes()], pa.binary()) for part in parts]
        return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in CHUNKS.split(", ")])


def _chunks(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {term: number for number, term in enumerate(sent.value)}
        chunk = _Chunk()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                chunk.add(doc_id, terms_of(text.as_py()), numbers)
                if chunk.full():
                    yield chunk.packed()
                    chunk = _Chunk()
        if chunk.documents:
            yield chunk.packed()

    return chunks


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by term, added up over the chunks of a task."""
    total: dict[int, int] = {}
    for batch in batches:
        for terms, starts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sizes = np.diff(np.frombuffer(starts, np.int32)).tolist()
            for term, size in zip(np.frombuffer(terms, np.int32).tolist(), sizes, strict=True):
                total[term] = total.get(term, 0) + size
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], ["term", "documents"]
    )


@dataclass(frozen=True)
class Ranking:
    """Items of a block with their terms by number, and what their scores need of all documents."""

    items: list[list[int]]
    weights: dict[int, int]
    documents: int
    terms: int


class Index:
    """The posting lists of a chunk, one after another, with their impacts and sparse tables."""

    def __init__(self, chunk: dict[str, bytes], ranking: Ranking):
        self.ids = np.frombuffer(chunk["ids"], np.int64)
        lengths, which = np.unique(np.frombuffer(chunk["lengths"], np.int64), return_inverse=True)
        share = [100 - 50 + 50 * n * ranking.documents // ranking.terms for n in lengths.tolist()]
        norms = 20 * np.array(share, np.int64)[which]
        terms = np.frombuffer(chunk["list_terms"], np.int32).tolist()
        sizes = np.diff(np.frombuffer(chunk["list_starts"], np.int32))
        self.places = np.frombuffer(chunk["places"], np.int32)
        tf = np.frombuffer(chunk["counts"], np.int32).astype(np.int64)
        weights = np.repeat(np.array([ranking.weights[term] for term in terms], np.int64), sizes)
        self.impacts = weights * (1_000_000_000 * tf // (1000 * tf + norms[self.places]))
        self.lists = {term: k for k, term in enumerate(terms) if ranking.weights[term]}
        #: Lists follow each other in the order of their numbers, places within a list too.
        self.keys = np.repeat(np.arange(len(terms)) * len(self.ids), sizes) + self.places
        self.table = self._table(int(sizes.max(initial=1)))

    def _table(self, longest: int) -> np.ndarray:
        """Row k: where the largest impact is among 2^k from each posting on."""
        count = len(self.places)
        levels = [np.arange(count, dtype=np.int32)]
        while (step := 1 << len(levels)) <= longest:
            below, level = levels[-1], levels[-1].copy()
            left, right = below[: count - step + 1], below[step // 2 : count - step + 1 + step // 2]
            level[: count - step + 1] = np.where(self.impacts[left] >= self.impacts[right], left, right)
            levels.append(level)
        return np.stack(levels)

    def lists_of(self, terms: list[int]) -> np.ndarray:
        """Numbers of the terms' lists."""
        return np.array([self.lists[term] for term in terms if term in self.lists], np.int64)

    def bounds(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the largest impacts of each interval, and the place of the largest of all.

        An interval is a row: where the postings of each list begin in it, and where they end.
        """
        some = end > first
        level = np.frexp(np.where(some, end - first, 1).astype(float))[1] - 1
        left = self.table[level, np.where(some, first, 0)]
        right = self.table[level, np.where(some, end - (1 << level), 0)]
        impacts, others = self.impacts[left], self.impacts[right]
        best = np.where(impacts >= others, left, right)
        impacts = np.where(some, np.maximum(impacts, others), 0)
        top = impacts.argmax(axis=1)
        return impacts.sum(axis=1), self.places[best[np.arange(len(best)), top]]

    def postings(self, lists: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a document stands, or would stand, in each list; and whether it does."""
        keys = lists[None, :] * len(self.ids) + places[:, None]
        found = np.searchsorted(self.keys, keys)
        return found, self.keys[np.minimum(found, len(self.keys) - 1)] == keys


class Best:
    """The documents with the highest scores, equal ones by id."""

    def __init__(self, most: int):
        self.most = most
        self.rows = np.empty((0, 2), np.int64)

    @property
    def least(self) -> int:
        """The lowest score that can still be among them."""
        return int(self.rows[-1, 1]) if len(self.rows) == self.most else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = scores >= self.least
        if keep.any():
            rows = np.concatenate([self.rows, np.column_stack([ids[keep], scores[keep]])])
            self.rows = rows[np.lexsort((rows[:, 0], -rows[:, 1]))[: self.most]]


def search(index: Index, terms: list[int], best: Best) -> int:
    """Add the documents of a chunk that are among the ``best``; returns how many were scored."""
    lists = index.lists_of(terms)
    if not len(lists):
        return 0
    first, _ = index.postings(lists, np.array([0]))
    end, _ = index.postings(lists, np.array([len(index.ids)]))
    bounds, splits = index.bounds(first, end)
    scored, together = 0, 4
    while True:
        open_ = np.flatnonzero(bounds >= best.least)
        if not len(open_):
            return scored
        together = min(2 * together, TOGETHER)
        if len(open_) > together:
            by_bound = np.argpartition(bounds[open_], len(open_) - together)
            now, rest = open_[by_bound[-together:]], open_[by_bound[:-together]]
        else:
            now, rest = open_, open_[:0]
        at, there = index.postings(lists, splits[now])
        impacts = np.where(there, index.impacts[np.where(there, at, 0)], 0)
        best.add(index.ids[splits[now]], impacts.sum(axis=1))
        scored += len(now)
        # What lies before the document, and what lies after it.
        parts = np.concatenate([first[now], at + there]), np.concatenate([at, end[now]])
        new_bounds, new_splits = index.bounds(*parts)
        new = new_bounds >= best.least
        first = np.concatenate([first[rest], parts[0][new]])
        end = np.concatenate([end[rest], parts[1][new]])
        bounds = np.concatenate([bounds[rest], new_bounds[new]])
        splits = np.concatenate([splits[rest], new_splits[new]])


def _searched(sent, top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking: Ranking = sent.value
        best = [Best(top) for _ in ranking.items]
        for batch in batches:
            for chunk in batch.to_pylist():
                index = Index(chunk, ranking)
                for terms, found in zip(ranking.items, best, strict=True):
                    search(index, terms, found)
        rows = np.concatenate([found.rows for found in best] or [np.empty((0, 2), np.int64)])
        items = np.repeat(np.arange(len(best), dtype=np.int32), [len(found.rows) for found in best])
        ids = pa.array(rows[:, 0], mask=rows[:, 0] == NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(items), ids, pa.array(rows[:, 1])], ["item", "doc_id", "score"])

    return searched


def term_weight(documents: int, with_term: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * with_term + 1)))


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``top`` documents of each item."""
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long"), whole_text(F.col("text")).alias("text"))
    asked = asked.mapInArrow(_item_terms, "item_id long, term string").distinct()
    asked = written(asked, "item-terms")
    blocks = max(1, -(-asked.count() // BLOCK_TERMS))
    texts = docs.select(F.col("doc_id").cast("long"), whole_text(F.col("text")).alias("text"))
    results = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        done = _rank_block(spark, texts, [(row.item_id, row.term.encode()) for row in rows], top)
        results = done if results is None else results.union(done)
    return results


def _rank_block(spark: SparkSession, texts: DataFrame, asked: list[tuple], top: int) -> DataFrame:
    vocabulary = sorted({term for _, term in asked})
    numbers = {term: number for number, term in enumerate(vocabulary)}
    by_item: dict[int | None, list[int]] = {}
    for item, term in sorted(asked, key=lambda row: row[1]):
        by_item.setdefault(item, []).append(numbers[term])
    sent = spark.sparkContext.broadcast(vocabulary)  # terms of a block: bounded
    chunks = written(texts.mapInArrow(_chunks(sent), CHUNKS), "chunks")
    total = chunks.agg(F.sum("documents"), F.sum("terms")).first()
    counted = chunks.select("list_terms", "list_starts").mapInArrow(_document_counts, "term int, documents long")
    counts = {row[0]: row[1] for row in counted.groupBy("term").agg(F.sum("documents")).collect()}
    weights = {term: term_weight(total[0], count) for term, count in counts.items()}
    ranking = Ranking(list(by_item.values()), weights, total[0] or 0, total[1] or 1)
    hits = chunks.mapInArrow(_searched(spark.sparkContext.broadcast(ranking), top), HITS)
    names = spark.createDataFrame(list(enumerate(by_item)), "item int, item_id long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return rank_documents(documents(spark, sf_dir), items)


#: The same by scores of all documents with a term of an item.
ORACLE = """
WITH words AS (
  SELECT 0 AS kind, row_number() OVER () AS row, doc_id AS id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents
  UNION ALL
  SELECT 1, 0, item_id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) FROM benchmark
), postings AS (
  SELECT row, id AS doc_id, term, count(*) AS tf FROM words WHERE kind = 0 GROUP BY ALL
), lengths AS (
  SELECT row, sum(tf)::BIGINT AS n FROM postings GROUP BY row
), totals AS (
  SELECT count(*) AS documents, sum(n)::BIGINT AS terms FROM lengths
), norms AS (
  SELECT row, 100 - 50 + (50 * n * documents) // terms AS m FROM lengths, totals
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, totals GROUP BY term
), scores AS (
  SELECT i.id AS item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM (SELECT DISTINCT id, term FROM words WHERE kind = 1) i
  JOIN weights USING (term) JOIN postings USING (term) JOIN norms USING (row)
  GROUP BY i.id, row, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank,
  doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
"""
