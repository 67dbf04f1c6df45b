"""Scores follow from the rows, not from their partitions."""

import random

import numpy as np


def rows_of(n):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(300)], k=rng.randrange(1, 90)))) for i in range(n)]
    # Repeated rows, one id with two texts, null ids, a null text, a long text.
    return [*rows, *[rows[3]] * 40, (5, "other words of five"), (None, "no id"), (None, "no id"), (7, None), (n, "w1 w2 " * 3000)]


def test_scores_are_equal_under_any_partitioning(llm, monkeypatch):
    """Many training groups, and the same rows in 1, 4 and 7 partitions in another order each time."""
    from milepost.llm import lm

    monkeypatch.setattr(lm, "GROUP_TOKENS", 4000)
    rows, seen = rows_of(400), []
    for n in (1, 4, 7):
        random.Random(n).shuffle(rows)
        got = lm.log_likelihoods(llm.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()
        assert len(got) == len(rows)
        seen.append(sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["score"]) for r in got))
    for other in seen[1:]:
        assert [r[:3] for r in other] == [r[:3] for r in seen[0]]
        assert np.allclose([r[3] for r in other], [r[3] for r in seen[0]], rtol=1e-6, atol=0)


def test_every_row_is_trained_on_once(llm, monkeypatch):
    from pyspark.sql import functions as F

    from milepost.llm import lm

    monkeypatch.setattr(lm, "GROUP_TOKENS", 100)
    rows = [(i % 7, 1, bytes([i % 7, 0])) for i in range(70)] + [(9, 2, b"")] * 300
    got, n = lm.dealt(llm.createDataFrame(rows, "id long, text_hash long, entries binary").repartition(5), 1000)
    assert n == 10 and got.groupBy("id").count().where("id = 9").first()["count"] == 300
    assert sorted((r["id"], bytes(r["entries"])) for r in got.collect()) == sorted((i, e) for i, _, e in rows)
    # Copies of one row go to several groups.
    assert got.where("id = 9").agg(F.count_distinct("group")).first()[0] > 5


def test_lookup_of_words():
    from milepost.llm import lm

    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(0, 1 << 62, 5000).astype(np.uint64))
    hashes[1::3] = hashes[::3][: len(hashes[1::3])] + np.uint64(1 << 40)  # equal low bits
    hashes = rng.permutation(np.unique(hashes))
    counts = np.arange(len(hashes), 0, -1)
    v = lm.Vocabulary.of(hashes, counts, int(counts.sum()), len(hashes))
    entry, count = v.find(np.concatenate((hashes, hashes + np.uint64(1 << 50))))
    assert (count[: len(hashes)] == counts).all() and (count[len(hashes) :] == -1).all()
    assert (entry[:4095] == np.arange(4095)).all() and (entry[4095:] == 4095).all()
