"""Vector best-fit packing of tokenised documents into sequences of bounded length.

A sequence has three capacities: tokens, documents, and attention cost (the sum of the
squared lengths). Pieces are placed from the longest down; each goes where it fits under
every capacity and where the weighted norm of what is left is least (or the weighted dot
product of need and rest is greatest, ``rule="dot"``).

Pieces of one length are alike, so the plan works on the number of pieces of each length,
2,048 numbers however large the corpus is, and on runs of sequences with the same content.
It comes back as a list of placements, a few for each length, bounded by the lengths as
well; a piece finds its place by its rank among the pieces of its length. Ranks come from
the place in the table of pieces, with counts by task and length added up before.

A null text is empty: its document is the closing id alone. Rows with the same id are
packed one by one, and so are null ids. An empty table gives an empty table.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableforge.llm.bpe import Codec, Memory, read_vocabulary
from tableforge.llm.common import documents, kept_by_worker, slices, whole_text, written

MAX_TOKENS = 2048
CLOSING_ID = 0
VOCABULARY = "word_bpe_49k.json"
#: Words, and pieces of words, whose ids a Python worker remembers; twice as many at most.
CACHE_WORDS = 250_000
CACHE_PIECES = 200_000
#: Marks of words that were met, by hash.
MET = 1 << 22

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"
)


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and the weight of each in the norm.

    With these defaults the number of documents and the attention cost never stop a
    piece that fits by its tokens, so that the number of sequences is as small as can be.
    """

    tokens: int = MAX_TOKENS
    documents: int = MAX_TOKENS
    cost: int = MAX_TOKENS * MAX_TOKENS
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001)


class MetAgain(Memory):
    """Remembers a word when it is met for the second time, as most words are met once."""

    def __init__(self, make: Callable, size: int):
        super().__init__(make, size)
        self.met, self.number = bytearray(MET), 0

    def __missing__(self, word):
        at = hash(word) % MET
        if self.met[at] or word in self.older:
            return super().__missing__(word)
        self.number += 1
        if 2 * self.number > MET:
            self.met, self.number = bytearray(MET), 0
        self.met[at] = 1
        return self.make(word)


class LibraryCodec(Codec):
    """Words taken apart as in ``bpe``; the merges are left to the tokenizers library.

    Ids of pieces are tuples of numbers that all pieces share: a remembered piece takes half
    the room of one with a list and numbers of its own.
    """

    def __init__(self, path: str):
        # Spark runs a task on each core; threads of the library would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        vocabulary = read_vocabulary(path)
        self.numbers = {number: number for number in vocabulary.ids.values()}
        # The tables of merges are the library's.
        super().__init__(replace(vocabulary, tokens={}, ranks={}, results=[]), CACHE_PIECES)
        self.pieces = MetAgain(self._encode_piece, CACHE_PIECES)
        self.model = Tokenizer.from_file(path).model

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        if not (piece.isascii() and piece.isprintable()):
            piece = "".join([self.vocabulary.letters[byte] for byte in piece.encode()])
        return tuple([self.numbers[token.id] for token in self.model.tokenize(piece)])

    def word_ids(self, word: bytes) -> bytes:
        """Ids of a word as little-endian 32-bit numbers."""
        text = word.decode()
        if text.isascii() and text.isalpha():
            return array("I", self.pieces[text.lower()]).tobytes()
        return array("I", self.encode(text)).tobytes()


def word_encoder(path: str) -> Callable[[bytes], bytes]:
    """Ids of a text as little-endian 32-bit numbers, by the tokenizers library.

    No token of this vocabulary spans white space, so each word is encoded once and the
    ids of a text are those of its words.
    """
    known = MetAgain(LibraryCodec(path).word_ids, CACHE_WORDS)
    return lambda text: b"".join(map(known.__getitem__, text.split()))


def _cut(path: str, max_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_by_worker(word_encoder, path)
        task = TaskContext.get().partitionId()
        closing = np.array([CLOSING_ID], "<u4").tobytes()
        places = np.zeros(max_tokens + 1, np.int64)
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(
                batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True
            ):
                ids = encode(text) + closing
                for piece, start in enumerate(range(0, len(ids) // 4, max_tokens)):
                    part = ids[4 * start : 4 * (start + max_tokens)]
                    length = len(part) // 4
                    rows.append((doc_id, piece, start, length, zlib.crc32(part), task, int(places[length])))
                    places[length] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = [part.split()[0] for part in PIECES.split(", ")]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names
            )

    return cut


def cut_pieces(docs: DataFrame, path: str, max_tokens: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), whole_text(F.col("text")).alias("text"))
    return rows.mapInArrow(_cut(path, max_tokens), PIECES)


def plan_placements(
    counts: dict[int, int], capacity: Capacity, rule: str = "norm"
) -> list[tuple[int, int, int, int, int, int]]:
    """Placements (length, first rank, end rank, first sequence, pieces in each, offset).

    A run of sequences with the same content is one row of ``state``: first sequence,
    number of sequences, and what is left of tokens, documents and cost.
    """
    full = np.array([capacity.tokens, capacity.documents, capacity.cost], np.int64)
    weights = np.array(capacity.weights)
    state = np.zeros((1024, 5), np.int64)
    used, sequences = 0, 0
    placements = []

    def add(first: int, number: int, rest: np.ndarray) -> None:
        nonlocal state, used
        if number > 0 and rest[0] > 0:
            if used == len(state):
                state = np.concatenate([state, np.zeros_like(state)])
            state[used] = [first, number, *rest]
            used += 1

    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length], np.int64)
        left, rank = counts[length], 0
        while left:
            rest = state[:used, 2:]
            fits = np.flatnonzero((rest >= need).all(axis=1))
            if len(fits):
                if rule == "dot":
                    best = fits[np.argmax((weights * need / full * (rest[fits] / full)).sum(axis=1))]
                else:
                    best = fits[np.argmin((weights * ((rest[fits] - need) / full) ** 2).sum(axis=1))]
                first, number = int(state[best, 0]), int(state[best, 1])
                room = state[best, 2:].copy()
                used -= 1
                state[best] = state[used]
            else:
                room = full
                number = -(-left // int((full // need).min()))
                first, sequences = sequences, sequences + number
            each = int((room // need).min())
            whole = min(number, left // each)
            offset = capacity.tokens - int(room[0])
            if whole:
                placements.append((length, rank, rank + whole * each, first, each, offset))
                add(first, whole, room - each * need)
                rank, left = rank + whole * each, left - whole * each
            if left and whole < number:
                placements.append((length, rank, rank + left, first + whole, left, offset))
                add(first + whole, 1, room - left * need)
                rank, left, whole = rank + left, 0, whole + 1
            add(first + whole, number - whole, room)
    return placements


def pack_documents(
    docs: DataFrame,
    path: str | None = None,
    capacity: Capacity = Capacity(),  # noqa: B008
    rule: str = "norm",
) -> DataFrame:
    """A row for each piece of each document, with its sequence and its place there."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path(VOCABULARY)
    longest = min(capacity.tokens, int(capacity.cost**0.5))
    pieces = written(cut_pieces(docs, path, longest), "pieces")
    by_task = pieces.groupBy("length", "task").count()
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select(
        "length", "task", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
    )
    bases = written(bases, "bases")
    counts = {row[0]: row[1] for row in bases.groupBy("length").agg(F.sum("count")).collect()}
    placements = spark.createDataFrame(
        plan_placements(counts, capacity, rule),
        "length long, first_rank long, end_rank long, first_sequence long, each long, base_offset long",
    )
    ranked = pieces.join(bases.drop("count"), ["length", "task"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("place"))
    # A few placements for each length: bounded by the capacity, not by the corpus.
    placed = ranked.join(F.broadcast(placements), "length").where(
        "rank >= first_rank and rank < end_rank"
    )
    nth = F.expr("(rank - first_rank) div each")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_sequence") + nth).alias("sequence_id"),
        (F.col("base_offset") + F.expr("(rank - first_rank) % each") * F.col("length")).alias("offset"),
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
