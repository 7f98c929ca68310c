"""Quality classifier: overlapping labellers, weighed by a model, teach a linear scorer.

Two things make a document unfit, low quality and toxicity; each has labellers that vote
unfit (-1), fit (1) or abstain (0): heuristics over the text, and the ``labels`` table
where it covers the document. Expectation-maximisation over the votes estimates how often
each labeller votes which way on fit and unfit documents; the posterior probabilities are
the labels a logistic scorer over hashed features learns from, by sparse online updates
(follow the regularised leader). A document is kept if neither score finds it unfit.

Quality is a matter of the whole text. A few words make a text toxic however long it is, so
toxicity is scored over windows of ``WINDOW`` words, each from the middle of the one before,
that together cover the text: the worst window's score is the text's, in training as well.
Nothing outside a window enters its score, so no amount of harmless text makes up for it.

The scorer is fitted on a bounded sample of about ``SAMPLE`` labelled documents (of all, if
none has a label), drawn by a hash of the id and each taken whole; it is fitted in one
task, and its weights (two arrays of ``WIDTH`` numbers) go to the tasks that score.
Documents whose id leaves remainder 0 by ``HELD_OUT`` are never in the sample, so that the
labels of these measure it. All documents are scored, in place, without a shuffle.

Null texts are empty; a text without words is rejected. Where no document has a label the
heuristics alone teach the scorer, also if there are labels of other documents; where only
held-out ids, or none, are left, the sample is drawn from these. Several labels of one id count as the worst of them.
Null ids are scored like others and never sampled. An empty table gives an empty table;
extra columns are kept, those named like a result column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tableforge.llm.bpe import Memory
from tableforge.llm.common import documents, give_back, kept_by_worker, slices, whole_text, written

SAMPLE = 12_000
HELD_OUT = 5
WIDTH = 1 << 18
EPOCHS = 6
#: Unfit documents are few; a miss of one counts so many times.
UNFIT_WEIGHT = 3.0
#: Evidence below which a feature has no weight at all.
SPARSENESS = {"quality": 16.0, "toxicity": 6.0}
#: Least probability of being fit; nearly all harmless documents are above 0.99.
THRESHOLDS = {"quality": 0.5, "toxicity": 0.88}
#: Words of a window whose toxicity is scored.
WINDOW = 32
CACHE_WORDS = 200_000
ROUNDS = 50
SYMBOLS = b"#*$%&|<>{}[]~^=+\\@_"
MARKS = ".,;:!?\"'()*%&$#|<>"
#: Words of abuse (fixed values).
INSULTS = frozenset((
    "clown disgusting dumb fool idiot idiots loser losers moron morons pathetic scum stupid "
    "trash vermin worthless"
).split())

#: Labellers of each kind: share of (unfit, abstain, fit) votes expected on unfit and on fit documents.
LABELLERS = {
    "quality": {
        "symbols": ((0.30, 0.30, 0.40), (0.01, 0.09, 0.90)),
        "repetition": ((0.30, 0.30, 0.40), (0.01, 0.09, 0.90)),
        "tables": ((0.30, 0.30, 0.40), (0.01, 0.09, 0.90)),
        "length": ((0.20, 0.30, 0.50), (0.02, 0.28, 0.70)),
        "given": ((0.90, 0.05, 0.05), (0.02, 0.05, 0.93)),
    },
    "toxicity": {
        "insults": ((0.60, 0.35, 0.05), (0.005, 0.495, 0.50)),
        "given": ((0.90, 0.05, 0.05), (0.02, 0.05, 0.93)),
    },
}
KINDS = tuple(LABELLERS)
PRIOR = {"quality": 0.88, "toxicity": 0.90}
#: Weight of what is expected, in documents for each document of the sample.
ANCHOR = 0.1


def text_numbers(text: str, words: list[str]) -> dict[str, float]:
    """Shares that the heuristics look at."""
    raw = text.encode()
    n_words, n_bytes = max(1, len(words)), max(1, len(raw))
    lines = [line for line in text.split("\n") if line.strip()]
    return {
        "words": len(words),
        "symbols": (len(raw) - len(raw.translate(None, SYMBOLS))) / n_bytes,
        "bars": words.count("|") / n_words,
        "variety": len(set(words)) / min(n_words, 1000),
        "lines": len(set(lines)) / max(1, len(lines)),
        "triples": len(set(zip(words, words[1:], words[2:], strict=False))) / max(1, n_words - 2),
    }


def _vote(bad: bool, good: bool) -> int:
    return -1 if bad else 1 if good else 0


def heuristic_votes(x: dict[str, float], words: list[str]) -> dict[str, dict[str, int]]:
    """Votes of the labellers that look at the text alone."""
    stripped = {word.strip(MARKS).lower() for word in set(words)}
    insults = len(stripped & INSULTS)
    return {
        "quality": {
            "symbols": _vote(x["symbols"] > 0.1, x["symbols"] < 0.02),
            "repetition": _vote(min(x["variety"] * 2, x["triples"], x["lines"]) < 0.5, x["triples"] > 0.9),
            "tables": _vote(x["bars"] > 0.15, x["bars"] < 0.02),
            "length": _vote(x["words"] < 8, x["words"] >= 40),
        },
        "toxicity": {"insults": _vote(insults > 0, False)},
    }


def fit_labellers(kind: str, votes: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Prior of fit, vote rates by (class, labeller, vote), and each row's probability of fit."""
    expected = np.array([[rates[c] for rates in LABELLERS[kind].values()] for c in (0, 1)])
    cells = (votes[:, :, None] == np.array([-1, 0, 1])).astype(float)
    prior, rates, extra = PRIOR[kind], expected, ANCHOR * max(1, len(votes))
    for _ in range(ROUNDS):
        logit = np.log(prior / (1 - prior)) + (cells * np.log(rates[1] / rates[0])).sum(axis=(1, 2))
        fit = 1 / (1 + np.exp(-logit))
        sums = np.stack([((1 - fit)[:, None, None] * cells).sum(axis=0), (fit[:, None, None] * cells).sum(axis=0)])
        sizes = np.array([(1 - fit).sum(), fit.sum()])[:, None, None]
        rates = (sums + extra * expected) / (sizes + extra)
        prior = (fit.sum() + extra * PRIOR[kind]) / (len(votes) + extra)
    return prior, rates, fit


def place(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % WIDTH


def word_places(word: str) -> list[int]:
    """Places of a word: itself, and its beginnings, which related words share."""
    name = word.strip(MARKS).lower()
    parts = ["insult"] if name in INSULTS else []
    parts += [f"w:{name}"] if name else []
    parts += [f"{size}:{name[:size]}" for size in (4, 6) if len(name) > size]
    return [place(part) for part in parts]


def number_places(x: dict[str, float]) -> list[int]:
    """Places of the shares, in steps."""
    steps = {"symbols": 50, "bars": 20, "variety": 10, "lines": 5, "triples": 10}
    parts = [f"{name}={int(x[name] * step)}" for name, step in steps.items()]
    return [place(part) for part in [*parts, f"words={int(x['words']).bit_length()}"]]


@dataclass
class Row:
    """A text to learn from: places of its distinct words, each once, and what its windows hold.

    ``words`` has the numbers of the distinct words of each window, one window after the
    other. Windows overlap, so these take a third of the room of their places.
    """

    numbers: np.ndarray
    places: np.ndarray
    sizes: np.ndarray
    words: np.ndarray
    counts: np.ndarray


def text_row(x: dict[str, float], words: list[str]) -> Row:
    number = {word: k for k, word in enumerate(set(words))}
    places = [word_places(word) for word in number]
    parts = [[number[word] for word in set(part)] for part in windows(words)]
    return Row(
        np.array([place("always"), *number_places(x)], np.int32),
        np.array([*chain.from_iterable(places)], np.int32),
        np.array([len(one) for one in places], np.uint8),
        np.array([*chain.from_iterable(parts)], np.min_scalar_type(len(number))),
        np.array([len(part) for part in parts], np.uint8),
    )


def windows(words: list[str]) -> list[list[str]]:
    """Windows that cover ``words``, each from the middle of the one before; one if there are no words."""
    half = WINDOW // 2
    return [words[at : at + WINDOW] for at in range(0, max(1, len(words) - half), half)]


def whole(row: Row, w: np.ndarray) -> np.ndarray:
    """Places of the whole text."""
    return np.concatenate([row.numbers, row.places])


def worst(row: Row, w: np.ndarray) -> np.ndarray:
    """Of the places of each window, those of the window with the lowest score."""
    # A window begins with the place of all texts, which is put after those of the words.
    places = np.append(row.places, row.numbers[0])
    sizes = np.append(row.sizes, 1).astype(np.int64)
    begins = np.cumsum(row.counts, dtype=np.int64) - row.counts
    words = np.insert(row.words.astype(np.int64), begins, len(row.sizes))
    long = sizes[words]
    ends = np.cumsum(long)
    at = np.repeat((np.cumsum(sizes) - sizes)[words] - (ends - long), long) + np.arange(ends[-1])
    found = places[at]
    firsts = begins + np.arange(len(begins))
    starts = (ends - long)[firsts]
    least = int(np.add.reduceat(w[found], starts).argmin())
    return found[starts[least] : starts[least + 1] if least + 1 < len(starts) else None]


#: What a kind is scored on.
CHOSEN = {"quality": whole, "toxicity": worst}


def train_scorer(kind: str, rows: list[Row], fit: np.ndarray, alpha: float = 0.5) -> np.ndarray:
    """Weights of a logistic scorer of ``fit`` (soft labels) over hashed places.

    The score of a row is that of the whole text, or of its worst window.
    """
    l1, choose = SPARSENESS[kind], CHOSEN[kind]
    z, n, w = np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(WIDTH)
    beta, l2 = 1.0, 0.1
    order = np.random.default_rng(7).permutation(len(rows))
    for _ in range(EPOCHS):
        for at in range(0, len(order), 16):
            part = order[at : at + 16]
            chosen = [choose(rows[k], w) for k in part]
            sizes = np.array([len(one) for one in chosen])
            places = np.concatenate(chosen)
            owner = np.repeat(np.arange(len(part)), sizes)
            score = np.bincount(owner, w[places], len(part))
            miss = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - fit[part]
            miss *= np.where(miss > 0, UNFIT_WEIGHT, 1.0)
            touched, back = np.unique(places, return_inverse=True)
            slope = np.bincount(back, miss[owner], len(touched))
            step = (np.sqrt(n[touched] + slope * slope) - np.sqrt(n[touched])) / alpha
            z[touched] += slope - step * w[touched]
            n[touched] += slope * slope
            zt = z[touched]
            w[touched] = np.where(
                np.abs(zt) <= l1, 0.0, -(zt - np.sign(zt) * l1) / ((beta + np.sqrt(n[touched])) / alpha + l2)
            )
    return w


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of text and given votes in, one row of weights for each kind out."""
    rows, votes = [], {kind: [] for kind in KINDS}
    for batch in slices(batches):
        for text, quality, toxic in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            words = text.split()
            x = text_numbers(text, words)
            found = heuristic_votes(x, words)
            found["quality"]["given"] = 0 if quality is None else 1 if quality else -1
            found["toxicity"]["given"] = 0 if toxic is None else -1 if toxic else 1
            for kind in KINDS:
                votes[kind].append([found[kind][name] for name in LABELLERS[kind]])
            rows.append(text_row(x, words))
    weights = []
    if not rows:
        return
    for kind in KINDS:
        _, _, fit = fit_labellers(kind, np.array(votes[kind]))
        weights.append(train_scorer(kind, rows, fit).astype("<f4").tobytes())
    del rows, votes
    give_back()  # the worker goes on to other tasks
    yield pa.RecordBatch.from_arrays([pa.array(KINDS), pa.array(weights, pa.binary())], ["kind", "weights"])


def _drawn(number: int, *by: str) -> Column:
    """About ``SAMPLE`` of ``number`` rows, by a hash of the id (and further columns)."""
    draw = F.pmod(F.xxhash64("doc_id", *by), F.lit(1_000_000))
    finer = F.pmod(F.xxhash64("doc_id", *by, F.lit(1)), F.lit(1_000_000_000)) / 1e9
    return draw + finer < F.lit(1_000_000 * SAMPLE / max(1, number))


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with the votes of ``labels``: a bounded number, drawn by hash of the id.

    Where no document has a label they are drawn from all but those held out, and where no
    others are left, from these.
    """
    usable = (F.col("doc_id") % HELD_OUT != 0) & F.col("doc_id").isNotNull()
    given = labels.where(usable).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    all_texts = docs.select("doc_id", whole_text(F.col("text")).alias("text"))
    texts = all_texts.where(usable)
    numbers = [given.count()]
    while numbers[-1]:
        # About SAMPLE rows of three numbers: a bound that does not grow with the corpus.
        drawn = F.broadcast(given.where(_drawn(numbers[-1])))
        sample = written(texts.join(drawn, "doc_id").select("text", "quality", "toxic"), "sample")
        if len(numbers) == 2 or not sample.isEmpty():
            return sample
        # The labels drawn are of other documents: draw among those of these documents.
        given = written(given.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "given")
        numbers.append(given.count())
    nothing = F.lit(None).cast("int")
    for rows in (texts, all_texts):
        sample = rows.where(_drawn(rows.count(), "text"))
        sample = sample.select("text", nothing.alias("quality"), nothing.alias("toxic"))
        if not sample.isEmpty():
            return sample.limit(4 * SAMPLE)  # also where most rows are alike
    return all_texts.select("text", nothing.alias("quality"), nothing.alias("toxic")).limit(SAMPLE)


def fit_classifier(docs: DataFrame, labels: DataFrame) -> dict[str, bytes]:
    sample = training_sample(docs, labels).select(
        "text", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")
    )
    # The sample is bounded, so one task can hold it; sorted, it is fitted alike each time.
    one = sample.repartition(1).sortWithinPartitions(F.xxhash64("text"), "text", "quality", "toxic")
    fitted = written(one.mapInArrow(_train, "kind string, weights binary"), "weights")
    weights = {row.kind: bytes(row.weights) for row in fitted.collect()}
    if not weights and not docs.isEmpty():
        raise ValueError("no document to fit the classifier on")
    return weights or {kind: np.zeros(WIDTH, "<f4").tobytes() for kind in KINDS}


def word_scores(*weights: bytes) -> tuple[np.ndarray, Memory]:
    """Weights of both kinds, and their sums by word."""
    by_kind = np.stack([np.frombuffer(one, "<f4") for one in weights]).astype(float)
    nothing = (0.0, 0.0)

    def sums(word: str) -> tuple[float, float]:
        found = tuple(map(float, by_kind[:, word_places(word)].sum(axis=1)))
        return found if any(found) else nothing  # most words have no weight: these share one pair

    return by_kind, Memory(sums, CACHE_WORDS)


def _score(weights: dict[str, bytes], at: int, keep: list[int]) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_kind, known = kept_by_worker(word_scores, *(weights[kind] for kind in KINDS))
        always = by_kind[:, place("always")]
        for batch in slices(batches):
            found = []
            for text in batch.column(at).to_pylist():
                text = text or ""
                words = text.split()
                quality = always[0] + by_kind[0, number_places(text_numbers(text, words))].sum()
                sums = {word: known[word] for word in set(words)}
                quality += sum([one for one, _ in sums.values()])
                toxic = {word: two for word, (_, two) in sums.items() if two}
                toxicity = always[1] + min([sum([toxic[w] for w in toxic.keys() & part]) for part in windows(words)])
                found.append((quality, toxicity, bool(words)))
            scores = np.array(found, float).reshape(-1, 3)
            fit = 1 / (1 + np.exp(-np.clip(scores[:, :2], -30, 30)))
            kept = (fit >= [THRESHOLDS[kind] for kind in KINDS]).all(axis=1) & (scores[:, 2] > 0)
            columns = [batch.column(k) for k in keep]
            names = [batch.schema.names[k] for k in keep]
            results = [pa.array(fit[:, 0]), pa.array(1 - fit[:, 1]), pa.array(kept)]
            yield pa.RecordBatch.from_arrays([*columns, *results], [*names, "quality_score", "toxic_score", "kept"])

    return score


def classify(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``quality_score``, ``toxic_score`` and ``kept``."""
    results = ("quality_score", "toxic_score", "kept")
    keep = [name for name in keep if name.lower() not in results]
    weights = fit_classifier(docs, labels)
    rows = docs.select(*keep)
    schema = StructType([*rows.schema.fields])
    if "text" in keep and schema["text"].dataType == StringType():
        at = keep.index("text")  # the text goes to the workers once
    else:
        at, rows = len(keep), docs.select(*keep, whole_text(F.col("text")).alias("__text"))
    for name, kind in zip(results, ("double", "double", "boolean"), strict=True):
        schema = schema.add(name, kind)
    return rows.mapInArrow(_score(weights, at, list(range(len(keep)))), schema)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(documents(spark, sf_dir), labels, ["doc_id"])
