"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from milepost.llm import spelling


def vocabulary(rows, least=7):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= least and n >= 2}


def one_apart(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least=7):
    words = vocabulary(rows, least)
    near = {w: [x for x in words if one_apart(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def result(llm, rows, **options):
    df = llm.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, n long, word string, form string").repartition(3)
    return sorted((tuple(r) for r in spelling.variants(df, **options).collect()), key=repr)


def made_up(seed, letters="abé", size=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(size)]
    words += [w + "Xyz"[: rng.randint(0, 3)] for w in words] + ["a" * k for k in range(5, 14)] * 3
    chosen = [w for w in words for _ in range(rng.choice([1, 2, 2, 3, 25, 300]))]
    rng.shuffle(chosen)
    return [(i, " ".join(chosen[i::40])) for i in range(40)]


@pytest.mark.parametrize("limit", [3, 50, 20_000])
def test_equals_plain_python(llm, limit):
    rows = made_up(limit)
    assert result(llm, rows, limit=limit) == brute(rows)


def test_small_batches(llm, monkeypatch):
    rows = made_up(9, "abcdefgh")
    llm.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert result(llm, rows) == brute(rows)
    finally:
        llm.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def test_edge_cases(llm, texts):
    rows = list(enumerate(texts)) + [(7, texts[7]), (None, "Straßenbahn strassenbahn Straßenbahn straßenbahm straßenbahm"), (50, "z" * 5000 + " " + "z" * 5000 + " " + "z" * 5001), (51, "z" * 5001)]
    rows += [(60, "variants " * 40 + "varients varients variantz variantz Ävariants Ävariants " + "variant's")]
    assert result(llm, rows) == brute(rows)


def test_chains_lead_to_the_last_form(llm):
    rows = [(None, "kettenwort " * 1000 + "kettenwart " * 100 + "kattenwart " * 8 + "kattenwarts")]
    rows.append((None, "kattenwart kattenwart kattenwarta"))
    rows.append((None, "zettenwort " * 2))
    assert result(llm, rows) == brute(rows)
    assert {r[2] for r in result(llm, rows)} == {"kettenwort"}


def test_no_words(llm, nothing):
    assert spelling.variants(nothing).collect() == []
    assert result(llm, [(1, None), (2, "")]) == []


def test_acceptor_is_minimal_and_numbers_words():
    """Equal endings share their states; a path tells the word's number."""
    words = sorted(a + b for a in ("ge", "ver", "zer") for b in ("legt", "legen", "setzt", "setzen"))
    points = np.array([ord(c) for c in "".join(words)], np.uint32)
    ends = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    a = spelling.Acceptor(points, ends, np.zeros(len(words), np.int64))
    assert len(set(a.classes)) == len({frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in {w[:i] for w in words for i in range(len(w) + 1)}})
    for number, word in enumerate(words):
        q, n = a.roots[0], a.base[0]
        for c in word:
            arc = a.first[q] + list(a.letter[a.first[q] : a.first[q + 1]]).index(ord(c))
            q, n = a.to[arc], n + a.passed[arc]
        assert n == number and a.final[q]
