"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import gzip
from collections import Counter

import pytest
from conftest import SMALL, plan_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tableforge.llm import (
    bpe,
    classifier,
    digests,
    katz,
    licenses,
    line_dedup,
    packing,
    quality_rules,
    simhash,
    warc,
)
from tableforge.workspace import new_folder

LONG = "word of a long text " * 4000
LINE = "A line that many of the documents share, word for word"
TEXTS = [
    (1, None), (2, ""), (3, " \n\t \n"), (4, "Same text, twice."), (4, "Same text, twice."),
    (4, "Other text under the same id"), (None, "No id but a text of its own"), (None, None),
    (5, LONG), (6, "x" * 50_000), (7, "one"), (8, "one two"),
    *[(k, f"Own words {k}\n  {LINE} \n{LINE.upper()}") for k in range(10, 16)],
]
SCHEMA = (
    "doc_id long, text string, kept string, posterior string, row string, n_lines string, "
    "component_id string, fp string, score string, lang string, source string, n_chars long"
)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "k", "p", "r", "l", "c", "f", "s", None, None, None) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(4, 1, 0), (4, 0, None), (5, 0, 1), (None, 1, 0), (8, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def by_id(frame) -> dict:
    return {row["doc_id"]: row for row in frame.collect()}


def test_rules(odd, none):
    judged = quality_rules.judge_documents(odd, odd.columns)
    rows = judged.collect()
    assert len(rows) == len(TEXTS) and judged.columns.count("kept") == 1
    found = {row["doc_id"]: row for row in rows}
    for i in (1, 2, 3):
        assert (found[i]["n_words"], found[i]["base_failed"], found[i]["kept"]) == (0, True, False)
    assert found[5]["n_repeat_words"] == found[5]["n_words"] == 20_000
    assert found[6]["word_chars"] == 50_000
    assert quality_rules.judge_documents(none, ["doc_id"]).collect() == []


def test_line_dedup(odd, none):
    done = line_dedup.dedup_lines(odd)
    rows = done.collect()
    assert len(rows) == len(TEXTS) and done.columns.count("n_lines") == 1
    found = {row["doc_id"]: row for row in rows}
    for i in (1, 2):
        assert (found[i]["n_lines"], found[i]["n_dropped"], found[i]["kept_text"]) == (1, 0, "")
    for k in range(10, 15):
        assert (found[k]["n_dropped"], found[k]["kept_text"]) == (2, f"Own words {k}")
    assert found[15]["n_dropped"] == 0
    assert found[10]["row"] == "r"
    assert line_dedup.dedup_lines(none).collect() == []


def test_lines_of_one_id_count_once(spark):
    rows = [(1, f"{LINE}\n{k}") for k in range(5)] + [(k, LINE) for k in range(2, 5)]
    done = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {row["n_dropped"] for row in done.collect()} == {0}
    rows.append((None, LINE))  # a null id is a document as well: now there are five
    done = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    dropped = {(row["doc_id"], row["text"]): row["n_dropped"] for row in done.collect()}
    assert {key: n for key, n in dropped.items() if not n} == {(4, LINE): 0}


def test_simhash(odd, none):
    found = simhash.near_duplicates(odd, odd.columns)
    rows = found.collect()
    assert len(rows) == len(TEXTS) and found.columns.count("component_id") == 1
    named = {(row["doc_id"], row["text"]): row for row in rows}
    assert named[None, None]["component_id"] == 1  # as all texts without a word
    assert {named[1, None]["fingerprint"], named[2, ""]["fingerprint"]} == {"0" * 16}
    assert named[4, "Same text, twice."]["component_id"] == 4
    assert named[None, "No id but a text of its own"]["component_id"] is None
    assert simhash.near_duplicates(none, ["doc_id"]).collect() == []
    left = simhash.keep_representatives(odd)
    assert left.columns == odd.columns
    ids = [row["doc_id"] for row in left.collect()]
    assert 1 in ids and 2 not in ids and 3 not in ids
    assert simhash.keep_representatives(none).collect() == []


def test_digests(odd, none):
    rows = digests.fingerprint_documents(odd).collect()
    assert len(rows) == len(TEXTS)
    found = {row["doc_id"]: row for row in rows}
    assert found[1]["fingerprint"] == "" and found[1]["n_chars"] == 0
    assert found[5]["n_chars"] == len(LONG)
    assert all(0 <= row["near_next"] <= 1 and 0 <= row["near_edited"] <= 1 for row in rows)
    same = [row["fingerprint"] for row in rows if row["doc_id"] == 4]
    assert len(set(same)) == 2
    assert digests.fingerprint_documents(none).collect() == []
    one = digests.fingerprint_documents(odd.where("doc_id = 7")).first()
    assert (one["near_next"], one["n_chars"]) == (1.0, 3)


def test_katz(odd, none):
    rows = katz.score_texts(odd).collect()
    assert len(rows) == len(TEXTS)
    assert {row["n_tokens"] for row in rows if row["doc_id"] in (1, 2, 3)} == {1}
    assert all(row["score"] < 0 and row["base_score"] < 0 for row in rows)
    assert not any(row["held_out"] for row in rows if row["doc_id"] is None)
    assert katz.score_texts(none).collect() == []


def test_chunks_do_not_change_scores(odd):
    def scores(**sizes) -> list[str]:
        rows = katz.score_texts(odd.coalesce(1), **sizes).collect()
        return sorted(str((row["doc_id"], row["n_known"], round(row["score"], 6))) for row in rows)

    assert scores(chunk_bytes=100) == scores()


def test_packing(odd, none):
    rows = packing.pack_documents(odd).collect()
    lengths = [row["length"] for row in rows if row["doc_id"] in (1, 2, 3)]
    assert lengths == [1, 1, 1]
    assert len({(row["sequence_id"], row["offset"]) for row in rows}) == len(rows)
    assert packing.pack_documents(none).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_keeps_every_capacity(rule):
    counts = {2048: 3, 1500: 10, 700: 40, 548: 7, 100: 200, 1: 5000}
    capacity = packing.Capacity(tokens=2048, documents=60, cost=2048 * 1024)
    counts.pop(2048)  # its cost alone is above the capacity
    counts.pop(1500)
    tokens, documents, cost = {}, {}, {}
    for length, first, end, sequence, each, offset in packing.plan_placements(counts, capacity, rule):
        for rank in range(first, end):
            k = sequence + (rank - first) // each
            assert offset + (rank - first) % each * length == tokens.get(k, 0)
            tokens[k] = tokens.get(k, 0) + length
            documents[k] = documents.get(k, 0) + 1
            cost[k] = cost.get(k, 0) + length * length
    assert sum(documents.values()) == sum(counts.values())
    assert max(tokens.values()) <= 2048
    assert max(documents.values()) <= 60 and max(cost.values()) <= 2048 * 1024


def test_bpe(odd, none):
    rows = by_id(bpe.encode_and_decode(odd))
    assert rows[1]["n_tokens"] == rows[3]["n_tokens"] == 0
    assert rows[1]["ids_sha256"] == rows[2]["ids_sha256"]
    assert rows[6]["n_tokens"] > 0
    assert bpe.encode_and_decode(none).collect() == []


def test_bpe_of_odd_letters_equals_the_library():
    import random

    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    codec, library = bpe.Codec(bpe.read_vocabulary(path), 50), Tokenizer.from_file(path)
    packed = packing.word_encoder(path)
    letters = ["a", "th", "É", "Σ", "İ", "'s", "'ll", " ", "\n", "\x1c", "\xa0", "漢字", "１２", "²", "!!",
               "<|endoftext|>", "😀", "́", "​", "ß", "\x85", "\x00", "l'"]
    draw = random.Random(1)
    for _ in range(800):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert [i for word in text.encode().split() for i in codec.encode(word.decode())] == ids
        assert list(memoryview(packed(text.encode())).cast("I")) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_classifier(odd, none, labels):
    judged = classifier.classify(odd, labels, odd.columns)
    rows = judged.collect()
    assert len(rows) == len(TEXTS) and judged.columns.count("kept") == 1
    assert not any(row["kept"] for row in rows if row["doc_id"] in (1, 2, 3))
    assert classifier.classify(none, labels, ["doc_id"]).collect() == []
    assert len(classifier.classify(odd, labels.limit(0), ["doc_id"]).collect()) == len(TEXTS)


def test_warc(spark):
    pages = [
        (1, "http://a b/\n", "<p>é</p>", "x"), (2, None, "<p>é</p>", "x"), (3, "u", None, "x"), (4, "u", "", "x"),
        (None, "u", "<p>é</p>", "x"), (5, "u", "a\r\n\r\nWARC/1.1\r\n", "x"), (5, "u", "a\r\n\r\nWARC/1.1\r\n", "x"),
        (6, "u", "z" * 300_000, "x"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, payload string")
    for version in (1, 2):
        arc, out = new_folder(spark, "arc"), new_folder(spark, "warc")
        warc.write_arc(frame, arc, version)
        back = sorted(((r.page_id or 0), bytes(r.payload).decode()) for r in warc.read_arc(spark, arc).collect())
        assert back == sorted((i or 0, html or "") for i, _, html, _ in pages)
        warc.convert_arc(spark, arc, out)
        rows = warc.read_warc(spark, out).where("record_type <> 'warcinfo'").collect()
        kinds = {(r.page_id, r.record_type, r.payload_bytes) for r in rows}
        assert kinds == {
            (1, "response", 9), (2, "revisit", 9), (3, "response", 0), (4, "revisit", 0), (None, "revisit", 9),
            (5, "response", 15), (5, "revisit", 15), (6, "response", 300_000),
        }
        assert {r.date for r in rows} == {"2024-01-01T00:00:00Z"}
        assert len({r.record_id for r in rows}) == len(rows) == len(pages)
        named = {r.record_id: r for r in rows}
        for row in rows:
            if row.record_type == "revisit":
                first = named[row.refers_to_id]
                assert (first.record_type, first.payload_digest) == ("response", row.payload_digest)
    arc, out = new_folder(spark, "arc"), new_folder(spark, "warc")
    warc.write_arc(frame.limit(0), arc)
    warc.convert_arc(spark, arc, out)
    assert warc.read_warc(spark, out).collect() == []


def test_first_occurrences_are_streamed_from_one_sort(spark):
    rows = spark.range(1000).selectExpr("id % 7 AS key", "CAST(id % 7 AS INT) AS key2", "id % 50 AS doc_id", "CAST(id AS INT) AS pos")
    done = line_dedup.repeated_lines(rows, 5)
    # Seen from above: the window, its sort with the position last, and the range exchange.
    plan = plan_of(done, "simple").partition(" Window [")[2].partition("rangepartitioning")[0]
    assert plan.count("Exchange ") == 1 and plan.count(" Sort [") == 1
    assert "pos" in plan.partition(" Sort [")[2].split("], ")[0].rsplit(",", 1)[1]
    assert sorted(map(tuple, done.collect())) == [(k, k, 49) for k in range(7)]


def test_classifier_without_labels_of_its_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    others = spark.range(1001, 1200).selectExpr("id * 1000 + 1 AS doc_id", "1 AS quality", "0 AS toxic")
    kept = {r.doc_id for r in classifier.classify(docs, none, ["doc_id"]).where("kept").collect()}
    assert 0.8 * docs.count() < len(kept) < docs.count()
    assert {r.doc_id for r in classifier.classify(docs, others, ["doc_id"]).where("kept").collect()} == kept
    held_out = docs.where(F.col("doc_id") % classifier.HELD_OUT == 0)
    for labels in (none, others):
        number = classifier.classify(held_out, labels, ["doc_id"]).where("kept").count()
        assert 0.7 * held_out.count() < number
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert classifier.classify(nameless, none, ["doc_id"]).where("kept").count() > 0.8 * docs.count()


def test_classifier_draws_a_bounded_sample_at_any_size(spark):
    ids = spark.range(200_000).withColumnRenamed("id", "doc_id")
    share = [ids.where(classifier._drawn(number)).count() for number in (200_000, 24_000_000, 12 * 10**12)]
    assert abs(share[0] - classifier.SAMPLE) < 600 and 50 < share[1] < 150 and share[2] == 0


BINARY = bytes(range(256)) * 4
ARC_RECORDS = [
    ("http://a.example/gone", "192.0.2.7", "20010203040506", "text/html",
     b"HTTP/1.0 404 Not Found\r\nServer: old/1.2\r\n\r\n<p>caf\xe9</p>"),
    ("dns:a.example", "192.0.2.1", "20010203040507", "text/dns", b"20010203\na.example. 3600 IN A 192.0.2.7\n"),
    ("http://a.example/\xef\xbb a b", "192.0.2.7", "200102030405", "image/png",
     b"HTTP/1.1 200 OK\nContent-Type: image/png\n\n" + BINARY),
    ("http://b.example/same", "-", "20010204", "image/png", b"HTTP/1.1 200 Fine\r\nX-A: 1\r\n\r\n" + BINARY),
    ("http://b.example/empty", "0.0.0.0", "never", "no-type", b""),
    ("http://b.example/head", "-", "20010203040506", "text/html", b"HTTP/1.1 204 No Content\r\n\r\n"),
    ("ftp://b.example/f", "-", "20010203040506", "application/octet-stream", b"\r\n\r\nWARC/1.0\r\n" + BINARY),
]


def foreign_arc(version: int) -> bytes:
    """An archive as other programs write it."""
    body = f"{version} 0 Somebody\nURL IP-address Archive-date Content-type Archive-length\n\n".encode()
    out = f"filedesc://old.arc 0.0.0.0 19990101000000 text/plain {len(body)}\n".encode() + body + b"\n"
    for url, ip, date, mime, block in ARC_RECORDS:
        between = "" if version == 1 else "404 - - 77 old.arc "
        out += url.encode("latin-1") + f" {ip} {date} {mime} {between}{len(block)}\n".encode() + block + b"\n"
    return out


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_archives_of_others_keep_their_bytes(spark, tmp_path, version, packed):
    arc, out = tmp_path / "arc", new_folder(spark, "warc")
    arc.mkdir()
    content = foreign_arc(version)
    (arc / "old.arc").write_bytes(gzip.compress(content) if packed else content)
    warc.convert_arc(spark, f"file://{arc}", out)
    rows = warc.read_warc(spark, out).collect()
    assert Counter(r.record_type for r in rows) == {"warcinfo": 1, "response": 3, "revisit": 1, "resource": 3}
    assert len({r.record_id for r in rows}) == len(rows)
    found = {r.target_uri: r for r in rows}
    info = found.pop(None)
    assert b"Somebody" in bytes(info.payload) and info.date == "1999-01-01T00:00:00Z"
    shown = [url.replace(" ", "%20").replace("\xef\xbb", "%EF%BB") for url, *_ in ARC_RECORDS]
    assert set(found) == set(shown)
    for url, (_, ip, _, mime, block) in zip(shown, ARC_RECORDS, strict=True):
        row = found[url]
        assert row.ip == (None if ip in warc.NO_ADDRESS else ip)
        if row.record_type == "resource":
            assert (bytes(row.payload), bytes(row.header), row.content_type) == (block, b"", mime)
        elif row.record_type == "response":
            assert bytes(row.header) + bytes(row.payload) == block
        else:
            assert block.startswith(bytes(row.header)) and row.payload_bytes == len(BINARY)
    assert bytes(found[shown[0]].header).startswith(b"HTTP/1.0 404 Not Found\r\nServer: old/1.2")
    # Without ids either of the two equal images may be the response.
    images = {found[shown[2]].record_type, found[shown[3]].record_type}
    assert images == {"response", "revisit"}
    dates = [found[url].date for url in shown]
    assert dates[:5] == ["2001-02-03T04:05:06Z", "2001-02-03T04:05:07Z", "2001-02-03T04:05:00Z",
                         "2001-02-04T00:00:00Z", "1999-01-01T00:00:00Z"]


def test_archives_are_closed_by_bytes(spark, monkeypatch):
    pages = spark.range(60).selectExpr("id AS page_id", "'u' AS url", "repeat(cast(id AS string), 40000) AS html")
    pack = warc._Pack(b"\n", b"opening")
    monkeypatch.setattr(warc, "FILE_BYTES", 100)
    contents = [batch.column(0)[0].as_py() for k in range(9) for batch in pack.add(b"x" * 30)]
    contents += [batch.column(0)[0].as_py() for batch in pack.rest()]
    assert [c.count(b"x") for c in contents] == [120, 120, 30] and all(c.startswith(b"opening\n") for c in contents)
    arc, out = new_folder(spark, "arc"), new_folder(spark, "warc")
    warc.write_arc(pages.repartition(2), arc)
    warc.convert_arc(spark, arc, out)
    rows = warc.read_warc(spark, out).where("record_type = 'response'").collect()
    assert {(r.page_id, bytes(r.payload).decode()) for r in rows} == {(k, str(k) * 40000) for k in range(60)}


def test_unknown_archives_are_refused():
    with pytest.raises(ValueError, match="version 3"):
        list(warc.parse_arc(b"filedesc://x 0.0.0.0 20240101000000 text/plain 6\n3 0 x\n"))
    with pytest.raises(ValueError, match="ends after"):
        list(warc.parse_arc(warc.arc_version_block(1) + b"u 0.0.0.0 20240101000000 text/html 99\nshort"))


def test_licenses(odd, none):
    rows = licenses.scan_licenses(odd).collect()
    assert len(rows) == len(TEXTS)
    assert {(r["n_words"], r["labels"], r["score"]) for r in rows if r["doc_id"] in (1, 2, 3)} == {(0, "", 0.0)}
    assert licenses.scan_licenses(none).collect() == []


def test_licenses_around_changed_words(spark):
    text = licenses.TEMPLATES["bsd"].replace("binary", "(really) Binary").replace("source", "src")
    rows = [(1, f"{'lead ' * 50}{text} tail"), (2, f"All rights reserved. {licenses.TEMPLATES['isc'][:40]}")]
    found = by_id(licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found[1]["labels"] == "bsd" and 0.8 <= found[1]["score"] < 1
    assert (found[2]["labels"], found[2]["first_word"]) == ("reserved", 0)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    last = len(corpus_pipeline.STAGES) - 1
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if k < last:
            assert out.columns == docs.columns
        out.write.parquet(path := new_folder(spark, "stage"))
        before, docs = docs, spark.read.parquet(path)
        kept = {row["doc_id"] for row in docs.select("doc_id").collect()}
        assert kept <= {row["doc_id"] for row in before.select("doc_id").collect()}
    assert docs.agg(F.count_distinct("doc_id")).first()[0] > 100


def test_pipeline_of_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:4]:
            assert stage(spark, docs, SMALL).columns == docs.columns
            stage(spark, docs, SMALL).collect()
