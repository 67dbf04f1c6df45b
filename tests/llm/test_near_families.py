"""Families of texts that are alike but mostly not linked, against plain Python."""

import os
import random

import pytest
from test_dedup import brute_near

from milepost.llm import near_dup

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def result(llm, rows, width, percent=80):
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return {tuple(r) for r in near_dup.near_duplicates(df, width, percent).collect()}


def family(seed, docs, words, changes):
    """Texts made from one by changes of their own, some of them made from another member."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    texts = []
    for _ in range(docs):
        text = list(rng.choice(texts)) if texts and rng.random() < 0.15 else list(base)
        for _ in range(rng.choice(changes)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(400)}"
        texts.append(text)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize(("seed", "width", "changes"), [(1, 2, (9, 10, 11, 12)), (2, 5, (3, 4, 5)), (3, 2, (6, 8, 14, 20))])
def test_similar_but_unlinked(llm, seed, width, changes):
    rows = list(enumerate(family(seed, 500, 130, changes)))
    assert result(llm, rows, width) == brute_near(rows, width, 80)


def test_a_large_family(llm):
    """Two thousand texts near the threshold; the last round's pairs stay far below all pairs."""
    made = []
    real = near_dup.written

    def spy(df, name):
        out = real(df, name)
        if name == "fourth":
            made.append(out.count())
        return out

    near_dup.written = spy
    try:
        rows = list(enumerate(family(7, 2000, 90, (6, 7, 8, 9))))
        got = result(llm, rows, 2)
    finally:
        near_dup.written = real
    assert got == brute_near(rows, 2, 80)
    assert made and made[0] < 2000 * 1999 / 2 / 50


def test_ids_with_several_texts(llm):
    texts = family(5, 240, 80, (7, 8, 9))
    rows = [(i % 200, t) for i, t in enumerate(texts)]
    assert result(llm, rows, 2) == brute_near(rows, 2, 80)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
def test_recall_on_the_driver_tables(llm):
    """Every document has the class that comparing all pairs gives it."""
    rows = [(r["doc_id"], r["text"]) for r in llm.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert result(llm, rows, 2) == brute_near(rows, 2, 80)
