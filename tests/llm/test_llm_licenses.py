"""License passages with words changed, dropped and put in."""

from __future__ import annotations

import random

import pytest

from tableforge.llm import licenses


def label_of(name: str) -> str:
    return licenses.LABELS.get(name, name)


def scanned(spark, texts: dict[int, str]) -> dict[int, set[str]]:
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {row["doc_id"]: row for row in licenses.scan_licenses(frame).collect()}
    assert rows.keys() == texts.keys()
    based = {i: set(row["base_labels"].split(",")) for i, row in rows.items()}
    return {i: set(row["labels"].split(",")) - {""} | (based[i] - {""}) for i, row in rows.items()}


@pytest.fixture(scope="module")
def prose() -> list[str]:
    random.seed(11)
    return ["".join(random.choices("abcdefghij", k=6)) for _ in range(900)]


def changed(kind: str, passage: str, seed: int) -> str:
    """The passage with a fifth of its words dropped or replaced, or as many put in, at places by chance."""
    pick = random.Random(seed)
    words = [word.decode() for word in licenses.words_of(passage.encode())]
    few = len(words) // 5
    places = sorted(pick.sample(range(1, len(words)), few), reverse=True)
    if kind == "middle":
        return " ".join([*words[: len(words) // 2], *["xyz"] * (len(words) // 2), *words[len(words) // 2 :]])
    for at in places:
        if kind == "dropped":
            del words[at]
        elif kind == "replaced":
            words[at] = "xyz"
    return " ".join(words)


@pytest.mark.parametrize("kind", ["whole", "dropped", "replaced", "middle"])
def test_changed_passages_are_found(spark, prose, kind):
    texts, wanted = {}, {}
    for number, (name, passage) in enumerate(licenses.TEMPLATES.items()):
        for seed in range(6):
            i = number * 10 + seed
            body = passage if kind == "whole" else changed(kind, passage, i)
            at = 70 * seed
            texts[i] = " ".join([*prose[:at], body, *prose[at : at + 40]])
            wanted[i] = label_of(name)
    found = scanned(spark, texts)
    based = set(licenses.PHRASES.values())
    for i, label in wanted.items():
        if kind == "whole":
            assert label in found[i] and found[i] - based <= {label}
        elif kind == "middle":
            assert label in found[i]
        else:  # a relation that lacks the very words that went may be as like
            assert found[i]
    hits = sum(label in found[i] for i, label in wanted.items())
    assert hits >= 0.95 * len(wanted)


def test_relations_are_told_apart(spark):
    names = ["agpl", "gpl-program", "lgpl", "cc-by-4.0", "cc-by-sa"]
    found = scanned(spark, {k: licenses.TEMPLATES[name] for k, name in enumerate(names)})
    assert [found[k] - {"gpl"} for k in (0, 2, 3, 4)] == [{"agpl"}, {"lgpl"}, {"cc-by"}, {"cc-by-sa"}]
    assert found[1] == {"gpl"}


def test_neighbouring_licenses_both_count(spark, prose):
    both = f"{licenses.TEMPLATES['mit']} {licenses.TEMPLATES['zlib']}"
    short = "Released under the BSD License. Released under our MIT License."
    again = " ".join([licenses.TEMPLATES["isc"]] * 300)
    found = scanned(spark, {1: both, 2: short, 3: again, 4: " ".join(prose)})
    assert found == {1: {"mit", "zlib"}, 2: {"mit"}, 3: {"isc"}, 4: set()}
