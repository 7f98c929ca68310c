"""Source mixes, hard negatives and lexical search: against SQL, plain programs and odd rows."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from oracle import differences
from pyspark.sql import functions as F

from tableforge.llm import lexical, mixing, negatives


@pytest.mark.parametrize("name", ["op11_source_mix", "op12_hard_negatives", "op13_lexical_search"])
def test_query_equals_sql(spark, name):
    assert differences(spark, name, SMALL) == []


DOCS = "doc_id long, text string, source string, size string, target string, place string, range string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, text, source, "s", "t", "p", "r") for i, text, source in rows], DOCS)


# Source mix


def filled(sizes: dict, weights: dict, budget: int, repeats: int = 3) -> dict:
    """Targets by filling one source after another."""
    full: set = set()
    while True:
        rest = budget - sum(repeats * sizes[s] for s in full)
        weight = sum(weights[s] for s in sizes if s not in full)
        targets = {s: repeats * sizes[s] if s in full else rest * weights[s] / weight for s in sizes}
        above = {s for s in sizes if s not in full and targets[s] > repeats * sizes[s]}
        if not above:
            return targets
        full |= above


def test_mix_gives_targets_within_a_document(spark):
    rows = [(i, "w " * (1 + i % 7), f"source {i % 9}") for i in range(900)]
    rows += [(1000 + i, "few words", "small") for i in range(3)]
    rows += [(2000 + i, "w " * 9, None) for i in range(40)]
    mix = mixing.mix_sources(docs_of(spark, rows))
    found = mix.plan.join(mix.sources.select("place", "source"), "place").collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _, _ in rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {name: 1 + k % 3 for k, name in enumerate(names)}
    targets = filled(sizes, weights, sum(sizes.values()))
    assert targets["small"] == 18
    taken, longest = Counter(), 9
    for row in found:
        assert row.target == pytest.approx(targets[row.source])
        assert row.source_size == sizes[row.source]
        assert row.taken == row.turns * row.size and 0 <= row.turns <= 3
        taken[row.source] += row.taken
    for name in names:
        assert abs(taken[name] - targets[name]) <= longest
    assert mix.budget - longest < sum(taken.values()) <= mix.budget == sum(sizes.values())


def test_mix_in_order_is_fair_all_along(spark):
    rows = [(i, "w " * (1 + i % 5), f"s{i % 4}") for i in range(2000)]
    mix = mixing.mix_sources(docs_of(spark, rows), mixing.MixRule((1, 4), 3, 0.5))
    sequence = mix.in_order().collect()
    assert [r.finish for r in sequence] == sorted(r.finish for r in sequence)
    ends = list(itertools.accumulate(r.size for r in sequence))
    assert [r.words_before for r in sequence] == [0, *ends[:-1]]
    shares = {r.place: r.target / mix.budget for r in sequence}
    given = Counter()
    for row in sequence:
        given[row.place] += row.size
        words = row.words_before + row.size
        if words > 500:
            assert all(abs(given[p] / words - share) < 0.05 for p, share in shares.items())
    # Shuffled: the ids of a source are neither in order nor by size.
    first = [r.doc_id for r in sequence if r.place == 0][:50]
    assert first != sorted(first) and len(set(first)) == 50


def test_mix_splits_ranges_of_any_size(spark, monkeypatch):
    rows = docs_of(spark, [(i, "w " * (1 + i % 11), f"s{i % 3}") for i in range(400)] * 2)
    whole = mixing.mix_sources(rows).plan.groupBy("doc_id").agg(F.sum("taken")).collect()
    monkeypatch.setattr(mixing, "RANGE_WORDS", 16)
    monkeypatch.setattr(mixing, "FAN", 4)
    monkeypatch.setattr(mixing, "COPIES", 1)
    split = mixing.mix_sources(rows).plan.groupBy("doc_id").agg(F.sum("taken")).collect()
    assert sorted(whole) == sorted(split)


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t", None), (None, "no id", "b"), (None, "no id", "b")]
    rows += [(4, "word " * 30_000, "c"), (5, "same", "b"), (5, "same", "b"), (5, "other text", "b"), (6, "x", "")]
    found = mixing.mix_sources(docs_of(spark, rows)).plan.collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter(
        (i, len((text or "").split())) for i, text, _ in rows
    )
    for row in found:
        if row.size == 0:
            assert row.taken == 0
    assert {r.target for r in found if r.doc_id in (1, 2, 3)} == {0.0}
    assert mixing.mix_sources(docs_of(spark, rows).limit(0)).plan.collect() == []
    wordless = mixing.mix_sources(docs_of(spark, rows[:3])).plan.collect()
    assert [(r.taken, r.target) for r in wordless] == [(0, 0.0)] * 3


# Hard negatives

VECTORS = "vec_id long, label int, embedding array<float>, uid string, score string, anchor string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, label, x, "u", "s", "a") for i, label, x in rows], VECTORS)


def mined(frame, **kinds):
    usable = negatives.usable_vectors(frame, F.col("label"))
    return negatives.mine_negatives(usable, F.col("vec_id") % 10 == 0, **kinds)


def plain_negatives(rows, rule=negatives.WindowRule()):
    out = []
    vectors = [(i, label, np.floor(256 * np.array(x, np.float32).astype(float)).astype(int)) for i, label, x in rows]
    for a, (anchor, label, c) in enumerate(vectors):
        if anchor is None or anchor % 10:
            continue
        scores = [(-int(c @ x), i, k, own == label) for k, (i, own, x) in enumerate(vectors) if k != a]
        for minus, positive, _, _ in sorted(s for s in scores if s[3])[: rule.positives]:
            fits = [s for s in sorted(scores) if not s[3] and -rule.low * minus <= -100 * s[0] <= -rule.high * minus]
            for rank, (score, i, _, _) in enumerate(fits[: rule.negatives], 1):
                out.append((anchor, positive, rank, i, -minus, -score))
    return Counter(out)


def rows_of(found):
    return Counter(tuple(r)[:6] for r in found.collect())


def test_negatives_equal_a_plain_program_and_skip_scores(spark):
    random = np.random.default_rng(7)
    centres = random.normal(size=(12, 16)) * 3
    rows = []
    for i in range(900):
        x = centres[i % 12] + random.normal(size=16) * 0.1
        rows.append((i, i % 5, [float(np.float32(v)) for v in x]))
    assert rows_of(mined(vectors_of(spark, rows).repartition(5))) == plain_negatives(rows)
    assert rows_of(mined(vectors_of(spark, rows).repartition(5), block=13)) == plain_negatives(rows)
    # The tree saves scores where anchors lie close together.
    vectors = np.array([np.floor(256 * np.array(x)) for _, _, x in rows]).astype(np.int64)
    ids, labels = np.arange(900), np.array([label for _, label, _ in rows])
    anchors = negatives.tree_of(ids[::10], ids[::10], labels[::10], vectors[::10])
    batch = negatives.Candidates(ids, ids, labels, vectors)
    high = {at: float(np.sort(vectors @ x)[-5]) for at, x in enumerate(anchors.vectors)}
    best = {}

    def wanted(at, batch, low, up):
        return np.flatnonzero(up >= high[at])

    def found(at, batch, pick, scores):
        best[at] = np.sort(scores)[-5:].tolist()

    scored = negatives.walk_batch(anchors, batch, wanted, found)
    assert scored < 0.5 * 900 * 90
    for at, x in enumerate(anchors.vectors):
        assert best[at] == np.sort(vectors @ x)[-5:].tolist()


def test_tree_has_the_shortest_edges():
    random = np.random.default_rng(1)
    vectors = random.integers(-9, 9, size=(40, 3)).astype(float)
    parent, edge = negatives.spanning_tree(vectors)
    pairs = sorted((math.dist(a, b), i, j) for (i, a), (j, b) in itertools.combinations(enumerate(vectors), 2))
    group = list(range(40))
    total = 0.0
    for length, i, j in pairs:
        if group[i] != group[j]:
            total += length
            group = [group[i] if g == group[j] else g for g in group]
    assert edge.sum() == pytest.approx(total)
    order = negatives.walk(parent)
    assert sorted(order) == list(range(40))
    assert all(order.index(p) < order.index(k) for k, p in enumerate(parent) if p >= 0)


def test_negatives_of_odd_rows(spark):
    near = [(i, i % 2, [1.0, 0.1 * (i % 4), 0.5]) for i in range(1, 40)]
    twice = [(10, 0, [1.0, 0.5, 0.5]), (10, 0, [1.0, 0.5, 0.5]), (10, 1, [1.0, 0.5, 0.4])]
    no_id = [(None, 0, [1.0, 0.25, 0.5]), (None, 1, [1.0, 0.25, 0.5])]
    out = [
        (20, None, [1.0, 1.0, 1.0]), (30, 0, None), (40, 1, [float("nan"), 0.0, 0.0]),
        (50, 1, [float("inf"), 0.0, 0.0]), (60, 1, [None, 0.0, 0.0]),
    ]
    low = [(70, 2, [-1.0, 0.0, 0.0]), (71, 2, [1.0, 0.0, 0.0]), (80, 3, [0.0, 0.0, 0.0]), (81, 3, [0.5, 0.0, 0.0])]
    rows = near + twice + no_id + low
    got = mined(vectors_of(spark, rows + out).repartition(3))
    as_last = [(negatives.NO_ID if i is None else i, label, x) for i, label, x in rows]
    expected = Counter(
        {
            tuple(None if v == negatives.NO_ID else v for v in row): n
            for row, n in plain_negatives(as_last).items()
        }
    )
    assert rows_of(got) == expected
    assert mined(vectors_of(spark, near).limit(0)).collect() == []
    assert mined(vectors_of(spark, [(1, 0, [1.0]), (2, 1, [1.0])])).collect() == []
    # Shorter vectors, empty ones and very large components.
    rows = [(10, 0, [1.0, 2.0]), (11, 0, [1.0]), (12, 1, []), (13, 1, [1.0]), (14, 0, [1e30, 1.0]), (15, 1, [5e5])]
    scores = {(r.positive_id, r.negative_id): r.negative_score for r in mined(vectors_of(spark, rows)).collect()}
    assert scores[11, 13] == 256 * 256
    assert scores[14, 15] == 256 * 256 * 500_000


# Lexical search

WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text):
    return re.findall(WORDS, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranks(docs, items, top=50):
    counts = [(i, Counter(words_of(text))) for i, text in docs]
    counts = [(i, c) for i, c in counts if c]
    number, total = len(counts), sum(sum(c.values()) for _, c in counts)
    having = Counter(term for _, c in counts for term in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words_of(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * number) // total
            score = 0
            for term in terms & c.keys():
                w = math.floor(1000 * math.log((2 * number + 2) / (2 * having[term] + 1)))
                score += w * ((1000000000 * c[term]) // (1000 * c[term] + 20 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        for rank, (minus, _, _, i) in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1):
            out.append((item, rank, i, -minus))
    return Counter(out)


def ranked(spark, docs, items, **kinds):
    docs = spark.createDataFrame([(i, t, "r", "s") for i, t in docs], "doc_id long, text string, rank string, score string")
    items = spark.createDataFrame([(i, t, "t") for i, t in items], "item_id long, text string, term string")
    return Counter(tuple(r) for r in lexical.rank_documents(docs.repartition(3), items, **kinds).collect())


def test_search_of_odd_rows(spark):
    docs = [
        (1, None), (2, ""), (3, "-- ,, !"), (4, "Same words here"), (4, "Same words here"), (None, "no id, same words"),
        (5, "wörter WÖRTER été 中文 a1b2"), (6, "long text of words " * 20_000), (7, "ABC abc aBc"),
    ]
    items = [(1, "same words"), (1, "here"), (2, None), (3, "..."), (4, "WÖRTER 中文 ÉTÉ"), (None, "abc"), (5, "absent")]
    assert ranked(spark, docs, items) == plain_ranks(docs, items)
    assert ranked(spark, docs, items, top=2) == plain_ranks(docs, items, 2)
    schema = "doc_id long, text string"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([(1, "one")], schema)
    as_items = one.withColumnRenamed("doc_id", "item_id")
    assert lexical.rank_documents(none, as_items).collect() == []
    assert lexical.rank_documents(one, as_items.limit(0)).collect() == []


def test_search_over_chunks_and_blocks_of_any_size(spark, monkeypatch):
    random = np.random.default_rng(3)
    vocabulary = [f"w{int(k)}" for k in range(60)]
    odds = 1 / np.arange(1, 61)
    text = lambda n: " ".join(random.choice(vocabulary, size=n, p=odds / odds.sum()))
    docs = [(i, text(int(random.integers(1, 40)))) for i in range(700)]
    docs += [(1000 + i, "w3 w7 w50") for i in range(90)]  # more ties than ranks
    items = [(i, text(6)) for i in range(12)] + [(99, "w3 w7 w50")]
    expected = plain_ranks(docs, items)
    assert ranked(spark, docs, items) == expected
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 20)
    assert ranked(spark, docs, items) == expected


def test_search_scores_few_documents():
    chunk = lexical._Chunk()
    numbers = {term.encode(): k for k, term in enumerate(("common", "often", "rare"))}
    for i in range(5000):
        words = ["common"] * (1 + i % 3) + ["often"] * (i % 2) + ["other"] * (i % 13) + ["rare"] * (i % 50 == 0)
        chunk.add(i, [word.encode() for word in words], numbers)
    packed = chunk.packed().to_pylist()[0]
    ranking = lexical.Ranking([[0, 1, 2]], {0: 30, 1: 700, 2: 3900}, 5000, chunk.terms)
    best = lexical.Best(50)
    scored = lexical.search(lexical.Index(packed, ranking), [0, 1, 2], best)
    assert scored < 1000
    everything = lexical.Best(50)
    index = lexical.Index(packed, ranking)
    at, there = index.postings(index.lists_of([0, 1, 2]), np.arange(5000))
    everything.add(index.ids, np.where(there, index.impacts[np.where(there, at, 0)], 0).sum(axis=1))
    assert best.rows.tolist() == everything.rows.tolist()
