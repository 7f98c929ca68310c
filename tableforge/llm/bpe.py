"""BPE encoding by a segment tree over the ranks of adjacent pairs, and decoding.

The leaves of the tree are the ranks of the pairs of a word's symbols, each with its
place; the root is then the leftmost pair of lowest rank. A merge changes three leaves and
the nodes above them, so a word of n symbols takes n log n steps, also if it is a line of
100,000 characters without a blank.

Words are independent of each other. A worker remembers the words it has met last, up to a
fixed number. Rows are independent too: nothing is shuffled.

A null text is empty and has no ids. Strings of special tokens in a text become their
ids. Rows with the same id are encoded each by its own text; an empty table gives an empty
table.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.llm.common import documents, whole_text

VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 350_000
NO_PAIR = 1 << 62
GONE = -1
PLACE = (1 << 32) - 1

#: White space of Unicode (fixed values).
UNICODE_BLANKS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """A visible character for each byte: its own where it has one, else from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(byte if byte in own else next(others)) for byte in range(256)]


@dataclass
class Vocabulary:
    """Tokens, merges and the pattern of words of one vocabulary file."""

    ids: dict[str, int]
    tokens: dict[int, str]
    ranks: dict[tuple[int, int], int]
    results: list[int]
    words: regex.Pattern
    special: regex.Pattern | None
    marks: set[str]
    suffix: str
    letters: list[str]


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    ids = model["vocab"]
    pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
    ranks = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}
    pattern = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    added = {token["content"]: token["id"] for token in content["added_tokens"]}
    special = "|".join(map(regex.escape, sorted(added, key=len, reverse=True)))
    return Vocabulary(
        ids | added,
        {number: token for token, number in (ids | added).items()},
        ranks,
        [ids[a + b] for a, b in pairs],
        regex.compile(pattern.replace(r"\s", UNICODE_BLANKS)),
        regex.compile(f"({special})") if special else None,
        {content[0] for content in added},
        model["end_of_word_suffix"] or "",
        byte_letters(),
    )


def merge_symbols(
    symbols: list[int], ranks: dict[tuple[int, int], int], results: list[int]
) -> list[int]:
    """``symbols`` with merges applied, the leftmost of lowest rank first, until none is left."""
    count = len(symbols)
    if count < 2:
        return symbols
    leaves = count - 1
    size = 1 << (leaves - 1).bit_length()
    rank_of = ranks.get
    tree = [NO_PAIR] * (2 * size)
    for at in range(leaves):
        rank = rank_of((symbols[at], symbols[at + 1]))
        if rank is not None:
            tree[size + at] = rank << 32 | at
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after = list(range(1, count + 1))
    before = list(range(-1, leaves))
    while (least := tree[1]) != NO_PAIR:
        at = least & PLACE
        gone = after[at]
        symbols[at] = results[least >> 32]
        symbols[gone] = GONE
        after[at] = following = after[gone]
        # The pairs at ``at`` and before it are new, and the pair at ``gone`` is no more.
        tree[size + at] = NO_PAIR
        last = at
        if gone < leaves:
            tree[size + gone] = NO_PAIR
            last = gone
        if following < count:
            before[following] = at
            rank = rank_of((symbols[at], symbols[following]))
            if rank is not None:
                tree[size + at] = rank << 32 | at
        first = before[at]
        if first >= 0:
            rank = rank_of((symbols[first], symbols[at]))
            tree[size + first] = NO_PAIR if rank is None else rank << 32 | first
        else:
            first = at
        low, high = size + first >> 1, size + last >> 1
        while low < high:  # the changed leaves are neighbours: they soon have one ancestor
            for node in range(low, high + 1):
                left, right = tree[2 * node], tree[2 * node + 1]
                tree[node] = left if left < right else right
            low >>= 1
            high >>= 1
        while low:
            left, right = tree[low + low], tree[low + low + 1]
            tree[low] = left if left < right else right
            low >>= 1
    return [symbol for symbol in symbols if symbol != GONE]


class Memory(dict):
    """Results by word, in two generations: when the younger is full, the older goes."""

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, word):
        found = self.older.get(word)
        if found is None:
            found = self.make(word)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class Codec:
    """Encoder and decoder over one vocabulary, with a bounded memory of words."""

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS):
        self.vocabulary = vocabulary
        self.pieces = Memory(self._encode_piece, cache_words)

    def _encode_piece(self, piece: str) -> list[int]:
        v = self.vocabulary
        letters = [v.letters[byte] for byte in piece.encode()]
        letters[-1] += v.suffix
        return merge_symbols([v.ids[letter] for letter in letters], v.ranks, v.results)

    def encode(self, text: str) -> list[int]:
        v, found = self.vocabulary, []
        parts = v.special.split(text) if v.special and v.marks & set(text) else [text]
        for k, part in enumerate(parts):
            if k % 2:
                found.append(v.ids[part])
                continue
            if part.isascii():
                lowered = part.lower()
            else:  # letter by letter: the case of a letter never depends on its neighbours here
                lowered = "".join(map(str.lower, unicodedata.normalize("NFC", part)))
            for piece in v.words.findall(lowered):
                found.extend(self.pieces[piece])
        return found

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.vocabulary.tokens[number] for number in ids])


@functools.cache
def word_codes(path: str) -> Memory:
    """Number of ids, ids and decoded text by word; a worker keeps it for the tasks to come."""
    codec = Codec(read_vocabulary(path))

    def code(word: bytes) -> tuple[int, str, str]:
        ids = codec.encode(word.decode())
        return len(ids), " ".join(map(str, ids)), codec.decode(ids)

    return Memory(code, CACHE_WORDS)


def _codes(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_codes(path)
        for batch in batches:
            rows = []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                # No token spans white space; words without a token leave nothing.
                counts, ids, decoded = list(zip(*map(known.__getitem__, text.split()), strict=True)) or [()] * 3
                if 0 in counts:
                    ids, decoded = filter(None, ids), filter(None, decoded)
                rows.append(
                    (
                        sum(counts),
                        hashlib.sha256(" ".join(ids).encode()).hexdigest(),
                        hashlib.sha256(" ".join(decoded).encode()).hexdigest(),
                    )
                )
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return codes


def encode_and_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Number and digest of each document's ids, and the digest of the decoded text."""
    rows = docs.select(F.col("doc_id").cast("long"), whole_text(F.col("text")).alias("text"))
    codes = _codes(path or public_tokenizers.path(VOCABULARY))
    return rows.mapInArrow(codes, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(documents(spark, sf_dir))
