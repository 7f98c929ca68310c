"""Document fingerprints held to a plain program, and their order over ranges of any size."""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SMALL

from tableforge.llm import digests


def plain_features(data: bytes) -> list[bytes]:
    """Windows of 16 bytes with 4 points, by the words of the module's docstring."""
    ranks = []
    for at in range(len(data) - 15):
        counts = Counter(data[at : at + 16]).values()
        steps = sum(round(65536 * n * math.log2(n)) for n in counts)
        entropy = 4 - steps / (16 * 65536)
        ranks.append(1001 if entropy < 1 else 1000 - round(min(abs(entropy - 3.1) / 0.25, 15) * 60))
    if not ranks:
        return []
    points = Counter()
    for first in range(-15, len(ranks)):
        inside = range(max(first, 0), min(first + 16, len(ranks)))
        points[min(inside, key=lambda at: (ranks[at], at))] += 1
    return [data[at : at + 16] for at in sorted(points) if points[at] >= 4 and ranks[at] <= 1000]


def plain_digest(text: str) -> list[set[int]]:
    data = text.encode()
    parts = list(dict.fromkeys(plain_features(data) or [data])) if data else []
    filters: list[set[int]] = []
    for number, part in enumerate(parts):
        if number % 160 == 0:
            filters.append(set())
        word = hashlib.sha1(part).digest()
        filters[-1] |= {int.from_bytes(word[k : k + 4], "big") % 2048 for k in range(0, 20, 4)}
    return filters


def plain_likeness(one: list[set[int]], other: list[set[int]]) -> float:
    def match(a: set[int], b: set[int]) -> float:
        chance = len(a) * len(b) / 2048
        most = min(len(a), len(b))
        floor = chance + 0.1 * (most - chance)
        common = len(a & b)
        return (common - floor) / max(most - floor, 1e-9) if common > floor else 0.0

    def mean(a: list[set[int]], b: list[set[int]]) -> float:
        return min(1.0, sum(max(match(x, y) for y in b) for x in a) / len(a))

    if one == other:
        return 1.0
    if not one or not other:
        return 0.0
    if len(one) == len(other):
        return (mean(one, other) + mean(other, one)) / 2
    return mean(*sorted((one, other), key=len))


def filters_of(fingerprint: str) -> list[set[int]]:
    bits = np.unpackbits(np.frombuffer(base64.b64decode(fingerprint), np.uint8)).reshape(-1, 2048)
    return [set(np.flatnonzero(row).tolist()) for row in bits]


def test_fingerprints_equal_a_plain_program(spark):
    table = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    docs = {row["doc_id"]: row["text"] or "" for row in table}
    docs = dict(sorted(docs.items(), reverse=True))
    ids = list(docs)
    rows = {row["doc_id"]: row for row in digests.op4_document_fingerprints(spark, SMALL).collect()}
    assert len(rows) == len(docs)
    own = {i: plain_digest(text) for i, text in docs.items()}
    assert max(map(len, own.values())) > 1  # chains of filters are among them
    for i, after in zip(ids, ids[1:] + ids[:1], strict=True):
        third = len(docs[i]) // 3
        other = plain_digest(docs[i][: len(docs[i]) - third] + docs[after][:third])
        row = rows[i]
        assert filters_of(row["fingerprint"]) == own[i]
        assert filters_of(row["edited_fingerprint"]) == other
        assert row["near_edited"] == pytest.approx(plain_likeness(own[i], other))
        assert row["near_next"] == pytest.approx(plain_likeness(own[i], own[after]))


def test_likeness_does_not_depend_on_the_order():
    random = np.random.default_rng(3)
    words = [bytes(random.integers(97, 123, 9).astype(np.uint8)) for _ in range(4000)]
    one, other = b" ".join(words[:3000]), b" ".join(words[900:3900])
    a, b = digests.digest(one), digests.digest(other)
    assert len(a) == len(b) > 256
    assert digests.likeness(a, b) == digests.likeness(b, a) > 0


def successors(frame) -> list[tuple]:
    """Each row's id and text with the text that the ranges give it as successor."""
    rows = frame.collect()
    found = []
    for k, row in enumerate(rows):
        if not row["borrowed"]:
            assert rows[k + 1]["part"] == row["part"]
            found.append((row["doc_id"], row["text"], rows[k + 1]["text"]))
    return found


@pytest.mark.parametrize("hot", [7, None])
def test_rows_of_one_id_are_dealt_over_many_ranges(spark, hot):
    rows = [(hot, f"text {k} of the hot id") for k in range(600)]
    rows += [(hot, "one text many times")] * 900 + [(k, f"text {k}") for k in range(100, 400)] + [(1, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    texts = frame.selectExpr("doc_id", "coalesce(text, '') AS text")
    dealt = digests.with_successors(texts)
    sizes = Counter(row["part"] for row in dealt.select("part", "borrowed").collect() if not row["borrowed"])
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(sizes) > ranges / 2 and max(sizes.values()) < 4 * len(rows) / ranges
    found = successors(dealt)
    hashes = {row["text"]: row["h"] for row in texts.selectExpr("text", "xxhash64(text) AS h").collect()}
    order = sorted(
        [(i, text or "") for i, text in rows], key=lambda row: (row[0] is None, -(row[0] or 0), hashes[row[1]])
    )
    after = [text for _, text in order[1:] + order[:1]]
    wanted = Counter((i, text, follows) for (i, text), follows in zip(order, after, strict=True))
    # Equal rows may change places: all but one of them are followed by their like.
    assert Counter(found).keys() <= wanted.keys()
    assert Counter((i, text) for i, text, _ in found) == Counter(order)
    single = {row: n for row, n in wanted.items() if row[1] != "one text many times"}
    assert {row: n for row, n in Counter(found).items() if row[1] != "one text many times"} == single
