"""Removal of passages that earlier documents have, against plain Python."""

import os
import random
import re
from hashlib import sha256

import numpy as np
import pytest

from milepost.llm import ragged, recompress

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute(rows, length=50):
    order = [float("inf") if i is None else i for i, _ in rows]
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for i, own in zip(order, words, strict=True):
        for at in range(len(own) - length + 1):
            key = tuple(own[at : at + length])
            least[key] = min(least.get(key, i), i)
    out = []
    for (doc, _), i, own in zip(rows, order, words, strict=True):
        cut = set()
        for at in range(len(own) - length + 1):
            if least[tuple(own[at : at + length])] < i:
                cut.update(range(at, at + length))
        kept = " ".join(w for k, w in enumerate(own) if k not in cut)
        out.append((doc, len(own), len(cut), sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(llm, rows, length=50):
    df = llm.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, key int, spans string, th int").repartition(3)
    return sorted((tuple(r) for r in recompress.digest(recompress.remove_repeats(df, length)).collect()), key=repr)


def passages(seed, letters, docs=60):
    """Texts made of shared passages, copies with small changes and words of few kinds."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 4)))
    shared = [[word() for _ in range(rng.randint(30, 160))] for _ in range(8)]
    out = []
    for _ in range(docs):
        text = []
        for _ in range(rng.randint(0, 5)):
            part = list(rng.choice(shared)) if rng.random() < 0.7 else [word() for _ in range(rng.randint(1, 120))]
            if rng.random() < 0.5:
                part[rng.randrange(len(part))] = "changed"
            low = rng.randrange(len(part))
            text += part[low:] if rng.random() < 0.3 else part
        out.append(rng.choice([" ", "\n", "  "]).join(text))
    return out


@pytest.mark.parametrize(("seed", "letters"), [(1, "abcdefgh"), (2, "a"), (3, "ab")])
def test_equals_plain_python(llm, seed, letters):
    rows = [((i * 7) % 61, t) for i, t in enumerate(passages(seed, letters))]
    assert result(llm, rows) == brute(rows)


def test_runs_and_periods(llm):
    """Long runs of one word and of two, at every phase and next to the least length."""
    rows = [(i, " ".join(["pre"] * (i % 3) + ["x"] * (48 + i % 5) + ["post"])) for i in range(12)]
    rows += [(20 + i, " ".join((["x", "y"] * 60)[i : 60 + 3 * i])) for i in range(8)]
    rows += [(40 + i, " ".join((["x", "x", "y"] * 60)[i : 52 + i] + ["end"] * i)) for i in range(6)]
    rows += [(60, "x " * 5000), (61, "x " * 5000), (62, "x " * 49)]
    assert result(llm, rows) == brute(rows)


def test_edge_cases(llm, texts):
    long = [str(i * 7919 % 10007) for i in range(400)]
    rows = list(enumerate(texts)) + [(7, texts[7]), (12, texts[12]), (None, " ".join(long)), (None, " ".join(long)), (90, "\t".join(long[10:300])), (91, " ".join(long[100:149])), (92, " ".join(long[100:150]))]
    rows += [(93, " ".join(long)), (93, " ".join(["other", *long])), (94, " ".join(long)), (95, "Tail " + "\x0b".join(long[200:260]))]
    assert result(llm, rows) == brute(rows)


def test_a_hot_passage_in_many_surroundings(llm):
    rng = random.Random(5)
    hot = [f"h{i}" for i in range(60)]
    rows = [(i, " ".join([f"a{rng.randrange(999)}" for _ in range(i % 70)] + hot + [f"b{rng.randrange(999)}" for _ in range(40)])) for i in range(400)]
    assert result(llm, rows) == brute(rows)


def test_longer_windows(llm):
    rows = list(enumerate(passages(7, "abc")))
    assert result(llm, rows, 63) == brute(rows, 63)
    with pytest.raises(ValueError, match="no whole symbol"):
        result(llm, rows, 20)


def test_nothing(llm, nothing):
    assert recompress.remove_repeats(nothing).collect() == []
    assert result(llm, [(1, None), (2, "")]) == brute([(1, None), (2, "")])


@pytest.mark.parametrize("letters", ["abcd", "ab", "a"])
def test_equal_windows_have_equal_symbols_inside(letters):
    rng = random.Random(3)
    for _ in range(40):
        own = [rng.choice(letters) for _ in range(50)]
        parses = []
        for _ in range(6):
            before = [rng.choice(letters) for _ in range(rng.randrange(30))]
            text = " ".join(before + own + [rng.choice(letters) for _ in range(rng.randrange(30))]).encode()
            words = recompress.Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
            names, start = recompress.recompressed(words.halves[0], np.arange(int(words.counts[0])) == 0)
            stop = np.append(start[1:], words.counts[0])
            inside = (start >= len(before) + recompress.MARGIN) & (stop <= len(before) + 50 - recompress.MARGIN)
            assert (stop - start).max() <= recompress.LONGEST and inside.any()
            parses.append((names[inside].tolist(), (start[inside] - len(before)).tolist()))
        assert all(p == parses[0] for p in parses)


def test_names_are_the_same_in_every_slice(llm, monkeypatch):
    monkeypatch.setattr(ragged, "SLICE", 300)
    rows = list(enumerate(passages(11, "abcdef", 20)))
    data = [t.encode() for _, t in rows]
    words = recompress.Words(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    alone = [recompress.Words(np.frombuffer(d, np.uint8), np.array([0, len(d)])) for d in data]
    assert words.halves[1].tolist() == [x for w in alone for x in w.halves[1].tolist()]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
def test_query_equals_plain_python(llm):
    from milepost.llm import queries

    rows = [(r["doc_id"], r["text"]) for r in llm.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.QUERIES["op13_substring_dedup"](llm, FOLDER).collect()), key=repr) == brute(rows)
