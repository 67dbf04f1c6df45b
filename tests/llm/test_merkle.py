"""The Merkle manifest against plain Python."""

import zlib
from hashlib import sha256

import pytest

from milepost.llm import merkle


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return hashed(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def grow(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [hashed(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        levels.append(nodes)
    return levels


def path(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = nodes[at // 3 * 3 : at // 3 * 3 + 3]
        out.append((run[: at % 3], run[at % 3 + 1 :]))
        at //= 3
    return out


def brute(rows):
    """Rows of doc_id, source, lang, n_chars, text."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: grow([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    high = grow([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, (_, _, h, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            steps = path(trees[s], at) + path(high, k)
            start = h
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                start = leaf((*r[:4], r[4].replace("\n", "")))
            for left, right in steps:
                start = hashed(*left, start, *right)
            proof = hashed(*[x for left, right in steps for x in (*left, *right)])
            out.append((r[0], h, trees[s][-1][0], high[-1][0], proof, start, start == high[-1][0]))
    return sorted(out, key=repr)


def frame(llm, rows):
    extra = [(*r, "x", 7, 1) for r in rows]
    return llm.createDataFrame(extra, "doc_id long, source string, lang string, n_chars long, text string, path string, idx int, tree int").repartition(3)


def result(llm, rows):
    return sorted((tuple(r) for r in merkle.audit(frame(llm, rows)).collect()), key=repr)


@pytest.mark.parametrize("sources", [1, 5])
@pytest.mark.parametrize("n", [1, 3, 4, 40])
def test_equals_plain_python(llm, n, sources):
    rows = [(i, f"s{'é' * (i % sources % 2)}{i % sources}", "en", i, f"line {i}\nmore\n" * (i % 3)) for i in range(n)]
    assert result(llm, rows) == brute(rows)


def test_nulls_ties_repeats_and_a_hot_source(llm, texts):
    rows = [(i, "hot" if i % 3 else None, None if i % 4 else "de", None if i % 5 else 0, t) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "hot", None, None, "a\nb"), (None, None, None, None, None), (3, "hot", "", 0, ""), (3, "hot", None, 0, ""), (7, "", "en", 1, "x\ny")]
    rows += [(1000 + i, "hot", "en", 4, "a\nb\n") for i in range(200)]
    assert result(llm, rows) == brute(rows)


def test_only_changed_texts_fail(llm):
    rows = [(i, f"s{i % 4}", "en", 1, "a\nb" if i % 2 else "ab") for i in range(60)]
    for r in merkle.audit(frame(llm, rows)).collect():
        assert r["verified"] == (r["doc_id"] % 2 == 0 or zlib.crc32(str(r["doc_id"]).encode()) % 2 == 1)


def test_another_arity_and_path(llm):
    rows = llm.createDataFrame([(i, "s", f"h{i}") for i in range(7)], "doc_id long, source string, leaf string")
    levels, tops = merkle.climb(merkle.numbered(rows.withColumnRenamed("leaf", "h"), "source", ["doc_id"]), arity=2)
    nodes = [f"h{i}" for i in range(7)]
    while len(nodes) > 1:
        nodes = [hashed(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    assert [r["h"] for r in tops.collect()] == nodes and len(levels) == 3


def test_empty_table(llm):
    assert result(llm, []) == []
