"""Near-duplicates, repeated strings and decontamination against brute force."""

import random
import re

import pytest

LOWER = {i: i + 32 for i in range(65, 91)}


def brute_near(rows, width, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = find(rows[i][0]), find(rows[j][0])
                parent[max(x, y)] = min(x, y)
    return {(i, len(s), find(i), find(i) == i) for (i, _), s in zip(rows, sets, strict=True)}


def varied(seed, n):
    """Texts in families, with some words changed, so that similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    out = []
    for f in range(n):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([3, 20, 60]))]
        for _ in range(rng.randrange(1, 7)):
            words = [w if rng.random() > 0.04 else f"v{rng.randrange(300)}" for w in base]
            out.append(" ".join(words) if rng.random() > 0.2 else " ".join(base).upper())
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_brute_force(llm, width):
    from milepost.llm.near_dup import near_duplicates

    rows = list(enumerate(varied(width, 60)))
    got = near_duplicates(llm.createDataFrame(rows, "doc_id long, text string").repartition(3), width).collect()
    assert {tuple(r) for r in got} == brute_near(rows, width, 80)


def test_near_duplicates_of_odd_rows(documents, texts, nothing):
    from milepost.llm.near_dup import near_duplicates

    got = near_duplicates(documents, 2).collect()
    assert len(got) == len(texts) + 2
    assert {tuple(r) for r in got} == brute_near(list(enumerate(texts)), 2, 80)
    assert near_duplicates(nothing, 2).count() == 0


def test_null_ids_stand_alone(llm):
    from milepost.llm.near_dup import near_duplicates

    got = near_duplicates(llm.createDataFrame([(None, "a b c"), (1, "a b c"), (2, "a b c")], "doc_id long, text string"), 2).collect()
    assert {tuple(r) for r in got} == {(None, 2, None, True), (1, 2, 1, True), (2, 2, 1, False)}


def repeating(seed):
    """Texts that share passages of many lengths, also within one text, and copies with small changes."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (10, 25, 26, 30, 60)]
    out = []
    for _ in range(30):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p) // 3) if rng.random() < 0.5 else 0
            parts += [" ".join(word() for _ in range(rng.randrange(0, 30))), p[cut:]]
        out.append(" ".join(parts))
    for t in out[:8]:
        at = rng.randrange(len(t))
        out.append(t[:at] + "#" + t[at + 1 :])
    return [*out, "ab" * 300, "ab" * 150 + "c" + "ab" * 150, None, ""]


@pytest.mark.parametrize("hot", [8000, 2])
def test_repeats_equal_brute_force(llm, monkeypatch, hot):
    """Both ways for grams with different contexts: sorted in a task, and counted by Spark."""
    from milepost.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "SORTED", hot)
    rows = list(enumerate(repeating(5)))
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.digest(suffix_dedup.remove_repeats(df, 120)).collect()}
    expected = suffix_dedup.brute_force([t for _, t in rows], 120)
    assert got == dict(enumerate(expected))
    assert sum(0 < x[1] < x[0] for x in expected) > 10


def test_repeats_of_odd_rows(documents, texts, nothing):
    from milepost.llm import suffix_dedup

    got = suffix_dedup.digest(suffix_dedup.remove_repeats(documents, 400)).collect()
    everything = [*texts, texts[7], texts[12]]
    expected = suffix_dedup.brute_force(everything, 400)
    assert sorted(tuple(r) for r in got) == sorted((i, *x) for i, x in zip([*range(len(texts)), 7, 12], expected, strict=True))
    assert suffix_dedup.remove_repeats(nothing, 400).count() == 0


def test_very_long_texts_are_cut_in_overlapping_segments(monkeypatch):
    import numpy as np

    from milepost.llm import ragged, suffix_dedup

    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    whole = suffix_dedup.anchors(data, np.array([0, 5000]), 150)
    monkeypatch.setattr(ragged, "SLICE", 700)
    monkeypatch.setattr(ragged.slices, "__defaults__", (700,))
    parts = suffix_dedup.anchors(data, np.array([0, 5000]), 150)
    assert [x.tolist() for x in whole] == [x.tolist() for x in parts]


def test_extents_of_one_sided_partners():
    """The longest extensions to the two sides come from different partners, so windows decide."""
    import numpy as np

    from milepost.llm import ragged, suffix_dedup

    rng = random.Random(3)
    for _ in range(60):
        base = [bytes(rng.choice(b"ab") for _ in range(260)) for _ in range(2)]
        contexts = {}
        for _ in range(rng.randrange(2, 9)):
            left, right = rng.randrange(37), rng.randrange(64, 101)
            contexts[base[rng.randrange(2)][100 - left : 100] + base[0][100:164] + base[rng.randrange(2)][164 : 100 + right], left] = 1
        raw, lefts = zip(*contexts, strict=True)
        data, ends, lefts = np.frombuffer(b"".join(raw), np.uint8), ragged.starts_of(np.array([*map(len, raw)])), np.array(lefts)
        l, r = suffix_dedup.extents(data, ends, lefts, np.ones(len(raw), int), np.array([len(raw)]), 100)
        for i in range(len(raw)):
            exact = suffix_dedup._by_bytes(data, ends[:-1] + lefts, lefts, np.diff(ends) - lefts, np.arange(len(raw)), i, 100)
            assert exact == ((l[i], r[i]) if l[i] + r[i] >= 100 else (0, 0))


def brute_contamination(docs, items, width=10):
    import hashlib

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    out = []
    for i, text in docs:
        w, hit, found = split(text), set(), set()
        for item, t in items:
            x = split(t)
            n = min(len(x), width)
            wins = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k : k + n]) in wins:
                    hit |= {*range(k, k + n)}
                    found.add(str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_contamination_equals_brute_force(llm, documents, texts, nothing, monkeypatch, broadcast):
    from milepost.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BROADCAST", broadcast)
    items = [(0, "one"), (1, texts[15]), (2, None), (3, ""), (10, "the cat sat"), (10, "THE CAT sat on"), (4, "x!! ??"), (5, "ab " * 12), (6, "zzz yyy"), (7, texts[12][40:200])]
    bench = llm.createDataFrame([(*x, 1) for x in items], "item_id long, text string, words int")
    got = sorted(tuple(r) for r in decontaminate.contamination(documents, bench).collect())
    assert got == brute_contamination([*enumerate(texts), (7, texts[7]), (12, texts[12])], items)
    assert decontaminate.contamination(nothing, bench).count() == 0
    none = decontaminate.contamination(documents, bench.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == len(texts) + 2
