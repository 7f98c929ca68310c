"""Katz backoff scores of texts, from Good-Turing discounted counts of words and word pairs.

The texts are cut into chunks of bounded size, written once as word numbers of their own.
A chunk asks for what it does not know in requests of sorted, packed keys, one for each
range of key hashes, and gets the answers back in the same order, so a pair that stands a
million times in a chunk is one key of six bytes or so, and no word, pair or document meets
all its like in one task. The number of ranges follows the number of tokens, so a range has a
bounded number of keys however large the corpus is:

1. words: counts of all chunks are added up for each key range and returned;
2. pairs: likewise; one chunk that has a pair is made its owner;
3. backoff weights: owners send what discounting their pairs has left to each history, and
   what the paired words have alone; the sums, in double precision throughout, give the
   weight that makes the probabilities after the history add up to one.

The answers are tables in the shared folder, partitioned by key range. Scores follow the
recursion: the discounted share of the pair where training texts have it, else the
history's weight times the probability of the word, which for unknown words is the mass
that discounting the word counts has left.

Good-Turing replaces a count r up to ``GOOD_TURING`` by (r + 1) n[r+1] / n[r]; a value out of
order, and all larger counts, lose a constant instead, so that some mass is always left.

A null text is empty: it has its end alone. A null id is no held-out document. Rows with the
same id are scored each by its own text. An empty table gives an empty table; extra columns
are not looked at. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.llm.common import documents, whole_text, written

FOLDS, HELD_OUT_FOLD = 7, 2
CHUNK_BYTES = 8 << 20
#: Keys that a range has on average at most, which bounds the memory of its task.
KEYS_PER_RANGE = 1 << 21
GOOD_TURING = 5
#: Counts of counts that the discounts need.
COUNTS_OF_COUNTS = GOOD_TURING + 1
#: Loss of a count where the counts of counts give none.
PLAIN_LOSS = 0.5
END = 0

CHUNKS = "chunk long, ids array<long>, sizes binary, held binary, hashes binary, tokens binary, n_tokens long"
ASKED = "chunk long, range int, keys binary, values binary"
ANSWERED = "chunk long, range int, values binary, counts array<long>"
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
)


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 as bytes of the least width that holds the largest."""
    width = max(1, (int(numbers.max()).bit_length() + 7) // 8) if len(numbers) else 1
    raw = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + raw.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    width = packed[0]
    raw = np.frombuffer(packed, np.uint8, offset=1).reshape(-1, width)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, :width] = raw
    return full.reshape(-1).view("<u8")


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed), dtype=np.uint64)


def ranges_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Range of each key: equal shares of the hashes, in order."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of each pair of hashes."""
    with np.errstate(over="ignore"):
        key = first * np.uint64(0x9E3779B97F4A7C15) + second
        key ^= key >> np.uint64(31)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
        return key * np.uint64(0x94D049BB133111EB)


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Documents as numbers into the chunk's own list of words; 0 is the end of a text."""
    number, size = TaskContext.get().partitionId() << 32, 0
    numbers: dict[bytes, int] = {}
    ids, sizes, held, tokens = [], [], [], []

    def whole() -> pa.RecordBatch:
        hashes = np.array([0, *map(xxhash.xxh64_intdigest, numbers)], np.uint64)
        hashes[END] = xxhash.xxh64_intdigest(b"", 1)
        columns = [
            pa.array([number], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())),
            *(
                pa.array([value], pa.binary())
                for value in (
                    pack(np.array(sizes, np.uint64)),
                    np.array(held, np.uint8).tobytes(),
                    hashes.tobytes(),
                    pack(np.concatenate(tokens)),
                )
            ),
            pa.array([sum(sizes)], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in CHUNKS.split(", ")])

    for batch in batches:
        flags = batch.column(1).to_pylist()
        texts = batch.column(2).cast(pa.binary())
        for k, doc_id in enumerate(batch.column(0).to_pylist()):
            text = texts[k].as_py()
            if ids and size + len(text) > chunk_bytes:
                yield whole()
                numbers, number, size = {}, number + 1, 0
                ids, sizes, held, tokens = [], [], [], []
            words = text.lower().split()
            place = numbers.setdefault
            found = [place(word, len(numbers) + 1) for word in words]
            found.append(END)
            ids.append(doc_id)
            sizes.append(len(found))
            held.append(flags[k])
            tokens.append(np.array(found, np.uint64))
            size += len(text)
    if ids:
        yield whole()


@dataclass
class Chunk:
    """A chunk, unpacked: ``previous`` is the word before each token, or the end."""

    ids: list[int | None]
    sizes: np.ndarray
    held: np.ndarray
    hashes: np.ndarray
    tokens: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Chunk:
        return cls(
            row["ids"],
            unpack(row["sizes"]).astype(np.int64),
            np.frombuffer(row["held"], np.uint8).astype(bool),
            np.frombuffer(row["hashes"], np.uint64),
            unpack(row["tokens"]).astype(np.int64),
        )

    @property
    def previous(self) -> np.ndarray:
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]  # the first of a text follows an end as well
        before[0] = END
        return before

    @property
    def training(self) -> np.ndarray:
        return np.repeat(~self.held, self.sizes)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of the distinct pairs, a token of each, and the pair of each token."""
        keys = pair_keys(self.hashes[self.previous], self.hashes[self.tokens])
        return np.unique(keys, return_index=True, return_inverse=True)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of the words, a number of each, and the place of each number."""
        return np.unique(self.hashes, return_index=True, return_inverse=True)


def _requests(
    chunk: int, keys: np.ndarray, values: np.ndarray, ranges: int, packed: Callable = pack
) -> Iterator[tuple]:
    """Rows of sorted ``keys`` and their ``values``, one for each range."""
    bounds = np.searchsorted(ranges_of(keys, ranges), np.arange(ranges + 1))
    for k in np.flatnonzero(np.diff(bounds)):
        part = slice(bounds[k], bounds[k + 1])
        yield chunk, int(k), pack_sorted(keys[part]), packed(values[part])


def _asked(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
        [part.split()[0] for part in ASKED.split(", ")],
    )


def _count_requests(pairs: bool, ranges: int) -> Callable:
    """What each chunk asks: its keys with its own training counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                chunk = Chunk.of(row)
                if pairs:
                    keys, _, place = chunk.pairs()
                else:
                    keys, _, place = chunk.words()
                    place = place[chunk.tokens]
                own = np.bincount(place[chunk.training], minlength=len(keys)).astype(np.uint64)
                yield _asked(list(_requests(row["chunk"], keys, own, ranges)))

    return ask


def _answer_counts(table: pa.Table) -> pa.Table:
    """Counts over all chunks for one range, twice the count and 1 for the owner.

    The first row also has how many keys have each small count, how many have any, and
    the sum of all counts.
    """
    keys = [unpack_sorted(value) for value in table.column("keys").to_pylist()]
    own = np.concatenate([unpack(value) for value in table.column("values").to_pylist()]).astype(np.int64)
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, own)
    counted = np.flatnonzero(own)
    owner = np.full(len(distinct), -1)
    owner[place[counted][::-1]] = counted[::-1]
    answers = total[place] * 2
    answers[owner[owner >= 0]] += 1
    few = np.bincount(np.minimum(total, COUNTS_OF_COUNTS + 1), minlength=COUNTS_OF_COUNTS + 2)
    counts = [*few[1 : COUNTS_OF_COUNTS + 1].tolist(), int((total > 0).sum()), int(total.sum())]
    parts = np.split(answers.astype(np.uint64), np.cumsum([len(part) for part in keys])[:-1])
    return _answered(table, [pack(part) for part in parts], counts)


def _answered(table: pa.Table, values: list[bytes], counts: list[int] | None = None) -> pa.Table:
    extra = [counts] + [None] * (len(values) - 1)
    return pa.table(
        {
            "chunk": table.column("chunk"),
            "range": table.column("range"),
            "values": pa.array(values, pa.binary()),
            "counts": pa.array(extra, pa.list_(pa.int64())),
        }
    )


@dataclass(frozen=True)
class Discounts:
    """Counts after discounting, from the counts of counts of all training texts."""

    small: tuple[float, ...]
    loss: float
    distinct: int
    total: int

    def of(self, counts: np.ndarray) -> np.ndarray:
        table = np.array([0.0, *self.small])
        return np.where(counts <= GOOD_TURING, table[np.minimum(counts, GOOD_TURING)], counts - self.loss)

    @property
    def left(self) -> float:
        """Share of all counts that discounting has taken away."""
        return self._lost / self.total if self.total else 1.0

    _lost: float = 0.0


def good_turing(few: list[int], distinct: int, total: int) -> Discounts:
    small = []
    for r in range(1, GOOD_TURING + 1):
        value = (r + 1) * few[r] / few[r - 1] if few[r - 1] else 0.0
        fits = 0 < value < r and (not small or value > small[-1])
        small.append(value if fits else r - PLAIN_LOSS)
    loss = min(0.95, max(0.05, GOOD_TURING - small[-1]))
    lost = sum(n * (r - value) for r, (n, value) in enumerate(zip(few, small, strict=False), 1))
    lost += loss * (distinct - sum(few[:GOOD_TURING]))
    return Discounts(tuple(small), loss, distinct, total, lost)


def _discounts(answers: DataFrame) -> Discounts:
    """From the counts of each range: a few sums."""
    sums = [F.sum(F.col("counts")[k]) for k in range(COUNTS_OF_COUNTS + 2)]
    row = [value or 0 for value in answers.where("counts is not null").agg(*sums).first()]
    return good_turing(row[:COUNTS_OF_COUNTS], row[-2], row[-1])


PARTIAL = (
    "chunk long, ids array<long>, held binary, sizes binary, known binary, base binary, partial binary, "
    "waiting binary, history binary, keys binary, left binary, backed binary"
)


def _score_without_weights(words: Discounts, pairs: Discounts) -> Callable:
    """Scores but for backoff weights, the tokens that wait for one, and what owners take."""

    def score(key: tuple, chunks: pa.Table, answers: pa.Table) -> pa.Table:
        row = chunks.to_pylist()[0]
        chunk = Chunk.of(row)
        told = sorted(answers.to_pylist(), key=lambda r: (r["kind"], r["range"]))
        numbers = [
            np.concatenate([unpack(r["values"]) for r in told if r["kind"] == kind]).astype(np.int64)
            for kind in ("pairs", "words")
        ]
        keys, _, place = chunk.words()
        counts = (numbers[1] >> 1)[place]  # of each word of the chunk
        known = counts > 0
        own = np.where(known, words.of(counts) / max(1, words.total), words.left)
        pair_keys_, at, pair = chunk.pairs()
        pair_counts, owned = numbers[0] >> 1, (numbers[0] & 1).astype(bool)
        history, word = chunk.previous[at], chunk.tokens[at]
        seen = pair_counts > 0
        share = np.where(seen, pairs.of(pair_counts) / np.maximum(counts[history], 1), own[word])
        log_share = np.log10(share)[pair]
        starts = np.cumsum(chunk.sizes) - chunk.sizes
        base = np.log10((counts + 1) / (words.total + words.distinct + 1))[chunk.tokens]
        # Tokens after a known history whose pair is new wait for the history's weight.
        waits = ~seen[pair] & known[chunk.previous]
        doc = np.repeat(np.arange(len(chunk.sizes)), chunk.sizes)[waits]
        needed, needs = np.unique(chunk.previous[waits], return_inverse=True)
        takers = history[owned]
        # What discounting has left, rather than one less what is taken, which would lose digits.
        lost = (pair_counts - pairs.of(pair_counts))[owned] / np.maximum(counts[takers], 1)
        left = np.bincount(takers, lost, len(counts))
        backed = np.bincount(takers, own[word[owned]], len(counts))
        asked = np.union1d(np.unique(takers), needed)
        order = np.argsort(chunk.hashes[asked], kind="stable")
        asked = asked[order]
        spot = np.empty(len(counts), np.int64)
        spot[asked] = np.arange(len(asked))
        result = {
            "chunk": [row["chunk"]],
            "ids": [row["ids"]],
            "held": [row["held"]],
            "sizes": [row["sizes"]],
            "known": [pack(np.add.reduceat(known[chunk.tokens].astype(np.uint64), starts))],
            "base": [np.add.reduceat(base, starts).tobytes()],
            "partial": [np.add.reduceat(log_share, starts).tobytes()],
            "waiting": [pack(doc.astype(np.uint64))],
            "history": [pack(spot[needed[needs]].astype(np.uint64))],
            "keys": [pack_sorted(chunk.hashes[asked])],
            "left": [left[asked].tobytes()],
            "backed": [backed[asked].tobytes()],
        }
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 10]
        return pa.table({k: pa.array(v, kind) for (k, v), kind in zip(result.items(), kinds, strict=True)})

    return score


def _weight_requests(ranges: int) -> Callable:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sums = np.stack([np.frombuffer(row[name]) for name in ("left", "backed")], axis=1)
                keys = unpack_sorted(row["keys"])
                yield _asked(list(_requests(row["chunk"], keys, sums, ranges, np.ndarray.tobytes)))

    return ask


def _answer_weights(table: pa.Table) -> pa.Table:
    """Backoff weight of each history: what is left to new words, by what they have alone.

    Shares are added in the order of the chunks, so that a repeated task gives equal sums.
    """
    table = table.sort_by("chunk")
    keys = [unpack_sorted(value) for value in table.column("keys").to_pylist()]
    sums = np.concatenate([np.frombuffer(value).reshape(-1, 2) for value in table.column("values").to_pylist()])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    left = np.bincount(place, sums[:, 0], len(distinct))
    backed = np.bincount(place, sums[:, 1], len(distinct))
    weight = np.log10(left / (1 - backed))
    parts = np.split(weight[place], np.cumsum([len(part) for part in keys])[:-1])
    return _answered(table, [part.tobytes() for part in parts])


def _score_with_weights(key: tuple, scored: pa.Table, answers: pa.Table) -> pa.Table:
    row = scored.to_pylist()[0]
    scores = np.frombuffer(row["partial"], float).copy()
    told = sorted(answers.to_pylist(), key=lambda r: r["range"])
    if told:
        weights = np.concatenate([np.frombuffer(r["values"]) for r in told])
        doc, history = (unpack(row[name]).astype(np.int64) for name in ("waiting", "history"))
        scores += np.bincount(doc, weights[history], len(scores)) if len(doc) else 0.0
    return pa.table(
        {
            "doc_id": pa.array(row["ids"], pa.int64()),
            "held_out": pa.array(np.frombuffer(row["held"], np.uint8).astype(bool)),
            "n_tokens": pa.array(unpack(row["sizes"]).astype(np.int64)),
            "n_known": pa.array(unpack(row["known"]).astype(np.int64)),
            "base_score": pa.array(np.frombuffer(row["base"], float)),
            "score": pa.array(scores),
        }
    )


def _asked_and_answered(requests: DataFrame, answer: Callable, ranges: int, label: str) -> DataFrame:
    dealt = requests.repartition(ranges // 2, "range")  # two ranges a task on average, at any size
    return written(dealt.groupBy("range").applyInArrow(answer, ANSWERED), label)


def _number_of_ranges(chunks: DataFrame) -> int:
    """Ranges by the number of tokens; no chunk asks for more keys than it has tokens."""
    tokens = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    least = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 2 * max(least, -(-tokens // (2 * KEYS_PER_RANGE)))


def score_texts(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Scores of all texts by a model of those outside the held-out fold.

    ``chunk_bytes`` bounds the memory of a task; a longer text is a chunk of its own.
    """
    doc_id = F.col("doc_id").cast("long")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    rows = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(fold == HELD_OUT_FOLD, F.lit(False)).alias("held"),
        whole_text(F.col("text")).alias("text"),
    )
    chunks = written(rows.mapInArrow(partial(_chunks, chunk_bytes=chunk_bytes), CHUNKS), "chunks")
    ranges = _number_of_ranges(chunks)
    answers = {}
    for kind in ("words", "pairs"):
        asked = chunks.mapInArrow(_count_requests(kind == "pairs", ranges), ASKED)
        answers[kind] = _asked_and_answered(asked, _answer_counts, ranges, kind)
    words, pairs = _discounts(answers["words"]), _discounts(answers["pairs"])
    told = None
    for kind, table in answers.items():
        part = table.select("chunk", "range", "values", F.lit(kind).alias("kind"))
        told = part if told is None else told.union(part)
    both = chunks.groupBy("chunk").cogroup(told.groupBy("chunk"))
    scored = written(both.applyInArrow(_score_without_weights(words, pairs), PARTIAL), "partial")
    asked = scored.select("chunk", "keys", "left", "backed").mapInArrow(_weight_requests(ranges), ASKED)
    weights = _asked_and_answered(asked, _answer_weights, ranges, "weights")
    small = scored.drop("keys", "left", "backed")
    both = small.groupBy("chunk").cogroup(weights.select("chunk", "range", "values").groupBy("chunk"))
    scores = both.applyInArrow(_score_with_weights, SCORES)
    return scores.withColumn("train_tokens", F.lit(words.total).cast("long"))


def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_texts(documents(spark, sf_dir))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
