"""What the Python workers of the operators hold at a time."""

from __future__ import annotations

import random
import tracemalloc
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
from conftest import SMALL

from tableforge.llm import classifier, packing


def random_texts(number: int, n_words: int) -> list[str]:
    draw = random.Random(5)
    known = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 9))) for _ in range(5000)]
    return [" ".join(draw.choices(known, k=n_words)) for _ in range(number)]


def peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_training_rows_take_little_more_than_their_texts(monkeypatch):
    monkeypatch.setattr(classifier, "EPOCHS", 1)
    texts = random_texts(600, 600)
    votes = pa.array([None] * len(texts), pa.int32())
    batch = pa.RecordBatch.from_arrays([pa.array(texts), votes, votes], ["text", "quality", "toxic"])
    arrays = 3 * 8 * classifier.WIDTH  # of the scorer, however many texts there are
    found = peak(lambda: list(classifier._train(iter([batch]))))
    assert found < arrays + 3.5 * sum(map(len, texts))


def test_scored_rows_come_in_small_batches():
    texts = [None, "", *random_texts(2000, 3)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    weights = {kind: np.linspace(-1, 1, classifier.WIDTH).astype("<f4").tobytes() for kind in classifier.KINDS}
    parts = list(classifier._score(weights, 1, [0, 1])(iter([batch])))
    assert max(part.num_rows for part in parts) <= 500
    whole = pa.Table.from_batches(parts)
    assert whole.column("doc_id").to_pylist() == list(range(len(texts)))
    assert whole.column("text").to_pylist() == texts
    assert whole.column("kept").to_pylist()[:2] == [False, False]


def test_a_text_that_is_kept_goes_to_the_workers_once(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "labels"))
    kept = classifier.classify(docs, labels, docs.columns)
    assert kept.columns == [*docs.columns, "quality_score", "toxic_score", "kept"]
    assert "__text" not in kept._jdf.queryExecution().analyzed().toString()
    cast = docs.withColumn("text", docs.text.cast("binary"))
    bare = classifier.classify(cast, labels, cast.columns)
    columns = ["doc_id", "quality_score", "toxic_score", "kept"]
    assert sorted(map(tuple, bare.select(columns).collect())) == sorted(map(tuple, kept.select(columns).collect()))


def test_remembered_words_take_little_room():
    texts = [text.encode() for text in random_texts(1, 5000)]
    more = [f"{a}{b}".encode() for a, b in zip(texts[0].decode().split(), range(5000), strict=True)]
    encode = packing.word_encoder(public_tokenizers.path(packing.VOCABULARY))
    found = peak(lambda: encode(b" ".join(more)))
    assert found < 350 * len(more)


def test_a_worker_keeps_what_one_operator_remembers():
    from tableforge.llm.common import kept_by_worker

    class Remembered:
        pass

    first = weakref.ref(kept_by_worker(Remembered))
    assert first() is not None and kept_by_worker(Remembered) is first()
    kept_by_worker(list)
    assert first() is None


def test_what_is_dropped_goes_back_to_the_system():
    from tableforge.llm.common import kept_by_worker

    def resident() -> int:
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096 // 2**20

    def many_blocks() -> list[np.ndarray]:
        blocks = [np.ones(1000) for _ in range(20_000)]  # 160 MB, below the last block
        pins.append(np.ones(1000))
        return blocks

    pins = []
    kept_by_worker(many_blocks)
    before = resident()
    kept_by_worker(list)
    assert before - resident() > 120


def test_words_met_once_are_not_remembered():
    made = []
    known = packing.MetAgain(lambda word: made.append(word) or word, 10)
    assert [known[word] for word in (b"a", b"b", b"a", b"a", b"a")] == [b"a", b"b", b"a", b"a", b"a"]
    assert made == [b"a", b"b", b"a"] and list(known) == [b"a"]
