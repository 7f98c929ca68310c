"""The classifier's verdicts and the pipeline's rows against a plain chain of the stages."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest import SMALL
from test_llm_exact import lower, plain_components, plain_fingerprint, rule_counts
from tokenizers import Tokenizer

import corpus_pipeline
from tableforge.llm import classifier as C
from tableforge.llm import katz, quality_rules


def read(query: str) -> list[tuple]:
    tables = {name: f"'{SMALL}/{name}.parquet'" for name in ("documents", "labels")}
    return duckdb.sql(query.format(**tables)).fetchall()


def shares(text: str) -> dict[str, float]:
    words, lines, raw = text.split(), [line for line in text.split("\n") if line.strip()], text.encode()
    many = max(1, len(words))
    threes = {tuple(words[k : k + 3]) for k in range(len(words) - 2)}
    return {
        "symbols": sum(map(raw.count, (bytes([mark]) for mark in C.SYMBOLS))) / max(1, len(raw)),
        "bars": words.count("|") / many,
        "variety": len(set(words)) / min(many, 1000),
        "lines": len(set(lines)) / max(1, len(lines)),
        "triples": len(threes) / max(1, many - 2),
    }


def sign(bad: bool, good: bool) -> int:
    return -1 if bad else int(good)


def votes(text: str, quality: int | None, toxic: int | None) -> dict[str, list[int]]:
    x, words = shares(text), text.split()
    abuse = any(word.strip(C.MARKS).lower() in C.INSULTS for word in words)
    return {
        "quality": [
            sign(x["symbols"] > 0.1, x["symbols"] < 0.02),
            sign(min(2 * x["variety"], x["triples"], x["lines"]) < 0.5, x["triples"] > 0.9),
            sign(x["bars"] > 0.15, x["bars"] < 0.02),
            sign(len(words) < 8, len(words) >= 40),
            0 if quality is None else (1 if quality else -1),
        ],
        "toxicity": [-1 if abuse else 0, 0 if toxic is None else (-1 if toxic else 1)],
    }


def soft_labels(kind: str, rows: list[list[int]]) -> list[float]:
    """Expectation-maximisation, row by row."""
    start = [[list(rates[c]) for rates in C.LABELLERS[kind].values()] for c in (0, 1)]
    prior, rates, extra = C.PRIOR[kind], start, C.ANCHOR * len(rows)
    for _ in range(C.ROUNDS):
        fit = []
        for row in rows:
            odds = prior / (1 - prior)
            for k, vote in enumerate(row):
                odds *= rates[1][k][vote + 1] / rates[0][k][vote + 1]
            fit.append(odds / (1 + odds))
        sizes = [sum(1 - p for p in fit), sum(fit)]
        sums = [[[0.0] * 3 for _ in start[0]] for _ in range(2)]
        for row, p in zip(rows, fit, strict=True):
            for k, vote in enumerate(row):
                sums[0][k][vote + 1] += 1 - p
                sums[1][k][vote + 1] += p
        rates = [
            [[(s + extra * e) / (sizes[c] + extra) for s, e in zip(ss, es, strict=True)] for ss, es in zip(sums[c], start[c], strict=True)]
            for c in (0, 1)
        ]
        prior = (sizes[1] + extra * C.PRIOR[kind]) / (len(rows) + extra)
    return fit


def spot(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % C.WIDTH


def of_words(words: list[str]) -> list[int]:
    found = []
    for word in sorted(set(words)):
        name = word.strip(C.MARKS).lower()
        found += [spot("insult")] * (name in C.INSULTS) + [spot(f"w:{name}")] * (name != "")
        found += [spot(f"{size}:{name[:size]}") for size in (4, 6) if len(name) > size]
    return found


def of_numbers(text: str) -> list[int]:
    steps = {"symbols": 50, "bars": 20, "variety": 10, "lines": 5, "triples": 10}
    x = shares(text)
    return [spot(f"{k}={int(x[k] * n)}") for k, n in steps.items()] + [spot(f"words={len(text.split()).bit_length()}")]


def parts(kind: str, text: str) -> list[list[int]]:
    """Places of the whole text, or of each window."""
    words = text.split()
    if kind == "quality":
        return [[spot("always"), *of_numbers(text), *of_words(words)]]
    starts = range(0, max(1, len(words) - C.WINDOW // 2), C.WINDOW // 2)
    return [[spot("always"), *of_words(words[at : at + C.WINDOW])] for at in starts]


def trained(rows: list[list[list[int]]], fit: list[float], l1: float) -> dict[int, float]:
    z, n, w = defaultdict(float), defaultdict(float), defaultdict(float)
    order = np.random.default_rng(7).permutation(len(rows))
    for _ in range(C.EPOCHS):
        for at in range(0, len(rows), 16):
            slopes = defaultdict(float)
            for k in order[at : at + 16]:
                worst = min(rows[k], key=lambda places: math.fsum(w[p] for p in places))
                miss = 1 / (1 + math.exp(-max(-30, min(30, math.fsum(w[p] for p in worst))))) - fit[k]
                for p in worst:
                    slopes[p] += miss * (C.UNFIT_WEIGHT if miss > 0 else 1)
            for p, slope in slopes.items():
                z[p] += slope - (math.sqrt(n[p] + slope * slope) - math.sqrt(n[p])) / 0.5 * w[p]
                n[p] += slope * slope
                over = abs(z[p]) - l1
                w[p] = -math.copysign(over, z[p]) / ((1 + math.sqrt(n[p])) / 0.5 + 0.1) if over > 0 else 0.0
    return w


@pytest.fixture(scope="module")
def judged() -> dict[int, tuple[float, float, bool]]:
    """Quality, toxicity and verdict of each document by the plain program."""
    texts = dict(read("SELECT doc_id, coalesce(text, '') FROM {documents}"))
    given = read("SELECT doc_id, min(quality), max(toxic) FROM {labels} WHERE doc_id % 5 <> 0 GROUP BY 1")
    sample = [(texts[i], q, t) for i, q, t in given if i in texts]

    def key(row):
        number = xxhash.xxh64_intdigest(row[0].encode(), 42)
        return number - (1 << 64) * (number >> 63), row[0].encode(), row[1], row[2]

    sample.sort(key=key)
    weights = {}
    for kind in C.KINDS:
        fit = soft_labels(kind, [votes(*row)[kind] for row in sample])
        weights[kind] = trained([parts(kind, text) for text, _, _ in sample], fit, C.SPARSENESS[kind])
    found = {}
    for i, text in texts.items():
        score = {
            kind: min(math.fsum(weights[kind][p] for p in places) for places in parts(kind, text)) for kind in C.KINDS
        }
        fit = {kind: 1 / (1 + math.exp(-max(-30, min(30, s)))) for kind, s in score.items()}
        kept = all(fit[kind] >= C.THRESHOLDS[kind] for kind in C.KINDS) and bool(text.split())
        found[i] = (fit["quality"], 1 - fit["toxicity"], kept)
    return found


def test_classifier_equals_a_plain_program(spark, judged):
    rows = C.op8_quality_classifier(spark, SMALL).collect()
    assert len(rows) == len(judged)
    for row in rows:
        quality, toxicity, kept = judged[row.doc_id]
        assert (row.quality_score, row.toxic_score) == (pytest.approx(quality, abs=1e-4), pytest.approx(toxicity, abs=1e-4))
        assert row.kept == kept


def kept_by_rules(texts: dict[int, str]) -> dict[int, str]:
    rows = []
    for text in texts.values():
        more = {"n_lines": text.count("\n") + 1, "n_distinct_words": len(set(re.findall(r"[^\x20\x09-\x0D]+", text)))}
        rows.append(rule_counts(text) | more)
    names = [name for name, _, _ in quality_rules.RULES]
    asked = ", ".join(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 2 ELSE 1 END" for _, bad, good in quality_rules.RULES)
    told = []
    for row in rows:
        values = ", ".join(f"{value} AS {name}" for name, value in row.items())
        told.append(duckdb.sql(f"SELECT {asked} FROM (SELECT {values})").fetchall()[0])
    start = quality_rules.starting_model()
    first = [[[start.rates[name, c, v] for v in (-1, 0, 1)] for name in names] for c in (0, 1)]
    prior, rates, extra = start.prior, first, quality_rules.ANCHOR * len(told)

    def good_share(row: tuple[int, ...]) -> float:
        odds = prior / (1 - prior)
        for k, vote in enumerate(row):
            odds *= rates[1][k][vote] / rates[0][k][vote]
        return odds / (1 + odds)

    for _ in range(quality_rules.ROUNDS):
        good = [good_share(row) for row in told]
        total = [len(told) - sum(good), sum(good)]
        sums = [[[extra * share for share in one] for one in first[c]] for c in (0, 1)]
        for row, p in zip(told, good, strict=True):
            for k, vote in enumerate(row):
                sums[0][k][vote] += 1 - p
                sums[1][k][vote] += p
        rates = [[[s / (total[c] + extra) for s in one] for one in sums[c]] for c in (0, 1)]
        prior = (total[1] + extra * start.prior) / (len(told) + extra)
    kept = {}
    for (i, text), row, vote in zip(texts.items(), rows, told, strict=True):
        failed = row["n_words"] < 20 or 100 * row["n_repeat_words"] > 30 * row["n_words"]
        if not failed and good_share(vote) >= quality_rules.MIN_POSTERIOR:
            kept[i] = text
    return kept


def without_repeated_lines(texts: dict[int, str]) -> dict[int, str]:
    def key(line: str) -> str:
        return lower(line.strip(" \t\n\x0b\f\r"))

    holders = defaultdict(set)
    for i, text in texts.items():
        for line in text.split("\n"):
            holders[key(line)].add(i)
    gone = {k: max(ids) for k, ids in holders.items() if len(k) >= 40 and len(ids) >= 5}
    return {
        i: "\n".join(line for line in text.split("\n") if gone.get(key(line), i) == i) for i, text in texts.items()
    }


def test_pipeline_equals_a_plain_chain(spark, judged):
    texts = dict(sorted(read("SELECT doc_id, coalesce(text, '') FROM {documents}")))
    sizes = [len(texts)]
    texts = {i: text for i, text in texts.items() if judged[i][2]}
    sizes.append(len(texts))
    texts = kept_by_rules(texts)
    sizes.append(len(texts))
    before, texts = texts, without_repeated_lines(texts)
    assert before != texts
    roots = plain_components([plain_fingerprint(text) for text in texts.values()])
    texts = {i: text for k, (i, text) in enumerate(texts.items()) if roots[k] == k}
    sizes.append(len(texts))
    assert sizes == sorted(set(sizes), reverse=True)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for i, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], "<u4")
            expected[i, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    ends = defaultdict(int)
    for row in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == ends[row.sequence_id]
        ends[row.sequence_id] += row.length
    assert max(ends.values()) <= 2048
    assert len(ends) <= -(-sum(row.length for row in rows) // 2048) * 1.02 + 1


def test_discounts_are_those_of_good_turing():
    few, distinct, total = [500, 200, 110, 70, 50, 38], 1200, 9000
    found = katz.good_turing(few, distinct, total)
    plain = [(r + 1) * few[r] / few[r - 1] for r in range(1, 6)]
    assert found.small == pytest.approx(plain) and found.loss == pytest.approx(5 - plain[-1])
    lost = sum(n * (r - value) for r, (n, value) in enumerate(zip(few, plain, strict=False), 1))
    assert found.left == pytest.approx((lost + (distinct - sum(few[:5])) * found.loss) / total)


def test_katz_with_ranges_by_the_number_of_tokens(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) < 2000")
    default = {r.doc_id: tuple(r) for r in katz.score_texts(docs, 20_000).collect()}
    monkeypatch.setattr(katz, "KEYS_PER_RANGE", 300)
    many = {r.doc_id: tuple(r) for r in katz.score_texts(docs, 20_000).collect()}
    assert len(many) == docs.count() and many.keys() == default.keys()
    for i, row in many.items():
        assert row == pytest.approx(default[i], rel=1e-6)
