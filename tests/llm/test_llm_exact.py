"""Registered queries of the corpus operators against plain programs over whole tables."""

from __future__ import annotations

import base64
import hashlib
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
from oracle import differences
from tokenizers import Tokenizer

import __spark_entry__ as registry
from tableforge.llm import classifier, digests, katz, licenses, quality_rules, simhash


@pytest.fixture(scope="module")
def texts() -> dict[int, str]:
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SMALL}/documents.parquet'").fetchall()
    return dict(rows)


@pytest.fixture(scope="module")
def tokenizer() -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def result(spark, name: str) -> list[dict]:
    return [row.asDict() for row in registry.queries()[name](spark, SMALL).collect()]


@pytest.mark.parametrize("name", ["op1_quality_rules", "op2_line_dedup", "op9_warc"])
def test_query_equals_sql(spark, name):
    assert differences(spark, name, SMALL) == []


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def rule_counts(text: str) -> dict[str, int]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    places = defaultdict(list)
    for at in range(len(words) - 7):
        places[tuple(words[at : at + 8])].append(at)
    covered = {at + k for found in places.values() if len(found) > 1 for at in found for k in range(8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_rules_count_and_weigh_as_a_plain_program(spark, texts):
    rows = result(spark, "op1_quality_rules")
    assert sorted(row["doc_id"] for row in rows) == sorted(texts)
    names = [name for name, _, _ in quality_rules.RULES]
    votes = np.array([[row[f"vote_{name}"] for name in names] for row in rows])
    start = quality_rules.starting_model()
    expected = np.array(
        [[[start.rates[name, kind, v] for v in (-1, 0, 1)] for name in names] for kind in (0, 1)]
    )
    prior, rates, extra = start.prior, expected, quality_rules.ANCHOR * len(rows)
    cells = (votes[:, :, None] == np.array([-1, 0, 1])).astype(float)

    def posterior() -> np.ndarray:
        weight = (cells * np.log(rates[1] / rates[0])).sum(axis=(1, 2))
        return 1 / (1 + np.exp(-(math.log(prior / (1 - prior)) + weight)))

    for _ in range(quality_rules.ROUNDS):
        good = posterior()
        sums = np.stack([np.einsum("d,drv->rv", share, cells) for share in (1 - good, good)])
        sizes = np.array([(1 - good).sum(), good.sum()])[:, None, None]
        rates = (sums + extra * expected) / (sizes + extra)
        prior = (good.sum() + extra * start.prior) / (len(rows) + extra)
    for row, good in zip(rows, posterior(), strict=True):
        counts = rule_counts(texts[row["doc_id"]])
        assert {name: row[name] for name in counts} == counts
        n = counts["n_words"]
        assert row["base_failed"] == (n < 20 or 100 * counts["n_repeat_words"] > 30 * n)
        assert row["posterior"] == pytest.approx(good, abs=1e-6)
        assert row["kept"] == (not row["base_failed"] and good >= quality_rules.MIN_POSTERIOR)


def plain_fingerprint(text: str) -> int:
    words = lower(text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    bits = [2 * sum(h >> bit & 1 for h in hashes) > len(hashes) for bit in range(64)]
    return sum(1 << bit for bit, on in enumerate(bits) if on)


def plain_components(fps: list[int]) -> list[int]:
    parent = list(range(len(fps)))

    def root(k: int) -> int:
        while parent[k] != k:
            k = parent[k]
        return k

    array = np.array(fps, np.uint64)
    for a in range(len(fps)):
        for b in np.flatnonzero(np.bitwise_count(array[a] ^ array[a + 1 :]) <= 3) + a + 1:
            x, y = root(a), root(int(b))
            parent[max(x, y)] = min(x, y)
    return [root(k) for k in range(len(fps))]


def test_simhash_equals_all_pairs(spark, texts):
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    expected = {
        i: (f"{fp:016x}", ids[root]) for i, fp, root in zip(ids, fps, plain_components(fps), strict=True)
    }
    rows = result(spark, "op3_simhash")
    assert {row["doc_id"]: (row["fingerprint"], row["component_id"]) for row in rows} == expected


@pytest.mark.parametrize("largest", [1 << 15, 40])
def test_links_of_clusters_join_what_all_pairs_join(spark, monkeypatch, largest):
    """Tight and loose clusters, chains, and groups that are dealt out anew."""
    monkeypatch.setattr(simhash, "MAX_GROUP", largest)
    random = np.random.default_rng(3)
    fps = {0, 1, (1 << 64) - 1}
    for spread in (4, 8, 20, 64):
        center = int(random.integers(0, 1 << 63))
        for _ in range(150):
            fps.add(center ^ sum(1 << int(b) for b in random.choice(spread, 3, replace=False)))
    now = int(random.integers(0, 1 << 63))
    for step in range(80):
        now ^= 1 << (step * 7 % 64)
        fps.add(now)
    fps.update(int(x) for x in random.integers(0, 1 << 63, 300))
    fps = sorted(fps)
    roots = plain_components(fps)
    frame = spark.createDataFrame([(simhash.signed(fp),) for fp in fps], "fp long")
    marked = frame.selectExpr("fp as doc_id", "fp")
    named = {row.fp: row.component_id for row in simhash.component_names(marked).collect()}
    groups = defaultdict(set)
    for fp, root in zip(fps, roots, strict=True):
        groups[root].add(simhash.signed(fp))
    assert len(named) == len(fps)
    for members in groups.values():
        assert {named[fp] for fp in members} == {min(members)}


def test_digests_equal_whole_computation(spark, texts):
    ids = sorted(texts, reverse=True)
    rows = {row["doc_id"]: row for row in result(spark, "op4_document_fingerprints")}
    assert len(rows) == len(ids)
    for at, i in enumerate(ids):
        text, following = texts[i], texts[ids[(at + 1) % len(ids)]]
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        own, other, after = (digests.digest(x.encode()) for x in (text, changed, following))
        row = rows[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert base64.b64decode(row["fingerprint"]) == own
        assert base64.b64decode(row["edited_fingerprint"]) == other
        assert row["near_edited"] == pytest.approx(digests.likeness(own, other))
        assert row["near_next"] == pytest.approx(digests.likeness(own, after))
    long = [row for row in rows.values() if row["n_chars"] >= 1000]
    assert np.mean([row["near_edited"] for row in long]) > 0.5
    assert np.median([row["near_next"] for row in long]) < 0.1


def test_window_entropies_equal_plain_counts():
    data = np.random.default_rng(5).integers(97, 105, 400).astype(np.uint8)
    found = digests.window_entropies(data)
    for at in range(len(found)):
        counts = np.array(list(Counter(data[at : at + 64].tolist()).values()))
        assert found[at] == pytest.approx(-(counts / 64 * np.log2(counts / 64)).sum(), abs=1e-4)


def test_katz_equals_plain_model_and_adds_up(spark, texts):
    rows = {row["doc_id"]: row for row in result(spark, "op5_katz_scores")}
    docs = {
        i: (lower(text).encode().split() + [None], zlib.crc32(str(i).encode()) % 7 == 2)
        for i, text in texts.items()
    }
    words, pairs = Counter(), Counter()
    for tokens, held in docs.values():
        if not held:
            words.update(tokens)
            pairs.update(zip([None, *tokens[:-1]], tokens, strict=True))
    total, distinct = sum(words.values()), len(words)

    def model(counts: Counter) -> katz.Discounts:
        few = Counter(counts.values())
        return katz.good_turing([few[r] for r in range(1, 7)], len(counts), total)

    of_words, of_pairs = model(words), model(pairs)

    def cut(d: katz.Discounts, count: int) -> float:
        return d.small[count - 1] if count <= katz.GOOD_TURING else count - d.loss

    def alone(word) -> float:
        return cut(of_words, words[word]) / total if words[word] else of_words.left

    assert sum(map(alone, words)) + of_words.left == pytest.approx(1)
    taken, backed = Counter(), Counter()
    for (history, word), count in pairs.items():
        taken[history] += cut(of_pairs, count) / words[history]
        backed[history] += alone(word)
    weight = {h: (1 - taken[h]) / (1 - backed[h]) for h in taken}

    def score(history, word) -> float:
        if pairs[history, word]:
            return cut(of_pairs, pairs[history, word]) / words[history]
        return weight.get(history, 1.0) * alone(word)

    for history in [None, *list(words)[:20]]:
        whole = sum(score(history, word) for word in words) + weight[history] * of_words.left
        assert whole == pytest.approx(1, rel=1e-10)
    held_out = [0.0, 0.0]
    for i, (tokens, held) in docs.items():
        row = rows[i]
        base = sum(math.log10((words[t] + 1) / (total + distinct + 1)) for t in tokens)
        own = sum(math.log10(score(h, t)) for h, t in zip([None, *tokens[:-1]], tokens, strict=True))
        found = (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"])
        assert found == (held, len(tokens), sum(words[t] > 0 for t in tokens), total)
        assert row["base_score"] == pytest.approx(base) and row["score"] == pytest.approx(own, rel=1e-11)
        held_out = [held_out[0] + held * own, held_out[1] + held * base]
    assert held_out[0] > held_out[1]


def test_packing_places_every_id_once(spark, texts, tokenizer):
    rows = result(spark, "op6_best_fit_packing")
    expected = []
    for i, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected.append((i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(row[name] for name in names) for row in rows) == sorted(expected)
    places = defaultdict(list)
    for row in rows:
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    for found in places.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= 2048
    fewest = -(-sum(row["length"] for row in rows) // 2048)
    assert len(places) <= fewest * 1.02 + 1


def test_bpe_equals_the_library(spark, texts, tokenizer):
    rows = {row["doc_id"]: row for row in result(spark, "op7_bpe")}
    assert len(rows) == len(texts)
    for i, text in texts.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        row = rows[i]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_licenses_equal_plain_search(spark, texts):
    rows = {row["doc_id"]: row for row in result(spark, "op10_license_scan")}
    assert len(rows) == len(texts)
    for i, text in texts.items():
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text).encode())
        starts, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            wanted = phrase.encode().split()
            found = [k for k in range(len(words)) if words[k : k + len(wanted)] == wanted]
            starts += found
            labels |= {label} if found else set()
        row = rows[i]
        assert (row["n_words"], row["n_base"]) == (len(words), len(starts))
        assert (row["first_word"], row["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert row["base_labels"] == ",".join(sorted(labels))
        given = set(row["labels"].split(",")) - {""}
        assert labels <= given and 0 <= row["score"] <= 1
        # The same spans by brute force: every start of every template.
        best = plain_licenses(words)
        assert row["score"] == pytest.approx(1.0 if labels else row["score"])
        for label in given - labels:
            assert best[label] >= 0.8
        for label, score in best.items():
            assert score < 0.8 or label in given or max(best.get(other, 0) for other in given) >= score


def common_words(one: list[bytes], other: list[bytes]) -> int:
    """Longest common subsequence, a row of the table after the other."""
    row = [0] * (len(other) + 1)
    for word in one:
        last = 0
        for k, wanted in enumerate(other, 1):
            last, row[k] = row[k], last + 1 if word == wanted else max(row[k], row[k - 1])
    return row[-1]


def plain_licenses(words: list[bytes]) -> Counter:
    """The best score of each label over every start, with as many words put in as there are."""
    best: Counter = Counter()
    for name, passage in licenses.TEMPLATES.items():
        wanted = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", passage.lower().encode())
        held = np.concatenate([[0], np.cumsum(np.isin(np.array(words, object), wanted))]) if words else np.zeros(1)
        label = licenses.LABELS.get(name, name)
        for k in range(len(words)):
            stop = min(len(words), k + 2 * len(wanted) + 12)
            if words[k] in wanted and held[stop] - held[k] >= 0.8 * len(wanted):
                best[label] = max(best[label], common_words(words[k:stop], wanted) / len(wanted))
    return best


def test_classifier_finds_unfit_documents(spark):
    """Labels of documents that are never in the sample measure the scorer."""
    sf_dir = SMALL.replace("0.001", "0.01")
    rows = {r["doc_id"]: r for r in registry.queries()["op8_quality_classifier"](spark, sf_dir).collect()}
    given = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{sf_dir}/labels.parquet'").fetchall()
    held = [(rows[i]["kept"], q == 1 and t == 0) for i, q, t in given if i % classifier.HELD_OUT == 0]
    assert sum(kept == fit for kept, fit in held) >= 0.85 * len(held)
    clean = [kept for kept, fit in held if fit]
    assert sum(clean) >= 0.95 * len(clean)


def test_classifier_finds_abuse_in_texts_of_any_length(spark):
    """Two abusive words in the middle of harmless texts; the ids of these have no label."""
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/labels.parquet")
    clean = duckdb.sql(
        f"SELECT text FROM '{SMALL}/documents.parquet' JOIN '{SMALL}/labels.parquet' USING (doc_id) "
        "WHERE quality = 1 AND toxic = 0 AND text IS NOT NULL ORDER BY doc_id"
    ).fetchall()
    pool = [word for (text,) in clean for word in text.split() if not {word.strip(classifier.MARKS).lower()} & classifier.INSULTS]
    lengths = [20, 100, 400, 1000, 2500, 5000, 10000]
    rows = [(-1 - k, " ".join([*pool[: n // 2], "You idiot , you are trash .", *pool[n // 2 : n]])) for k, n in enumerate(lengths)]
    rows += [(-101 - k, " ".join(pool[:n])) for k, n in enumerate(lengths)]
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    found = classifier.classify(docs.union(planted), labels, ["doc_id"]).where("doc_id < 0").collect()
    scores = {row["doc_id"]: row["toxic_score"] for row in found}
    limit = 1 - classifier.THRESHOLDS["toxicity"]
    assert {n: scores[-1 - k] > limit for k, n in enumerate(lengths)} == dict.fromkeys(lengths, True)
    assert all(scores[-101 - k] <= scores[-1 - k] for k in range(len(lengths)))
    assert not any(row["kept"] for row in found if row["doc_id"] > -100)


def test_digests_of_short_texts_show_edits(texts):
    """Cuts of real texts whose last third is replaced stay like themselves; strangers are not."""
    long = [text for _, text in sorted(texts.items()) if len(text) >= 1000]
    for size in (60, 90, 126, 200, 300):
        cuts = [text[100 : 100 + size] for text in long]
        own = [digests.digest(cut.encode()) for cut in cuts]
        after = cuts[1:] + cuts[:1]
        changed = [digests.edited(cut, other).encode() for cut, other in zip(cuts, after, strict=True)]
        near = [digests.likeness(one, digests.digest(data)) for one, data in zip(own, changed, strict=True)]
        assert np.median(near) > 0.4 and np.mean(np.array(near) > 0) > 0.97
        assert np.median([digests.likeness(a, b) for a, b in zip(own, own[1:], strict=False)]) < 0.1
