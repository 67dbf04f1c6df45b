"""Null ids in decontamination and removal of repeats, against brute force."""

import pytest
from conftest import long_text
from test_dedup import brute_contamination, repeating

ITEM = "the quick brown fox jumps over the lazy dog again and again"


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_contamination_of_rows_without_id(llm, monkeypatch, broadcast):
    from milepost.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BROADCAST", broadcast)
    rows = [(None, ITEM), (1, ITEM), (None, "something else"), (None, None), (None, "so " + ITEM), (None, ITEM)]
    bench = llm.createDataFrame([(4, ITEM)], "item_id long, text string")
    got = decontaminate.contamination(llm.createDataFrame(rows, "doc_id long, text string").repartition(2), bench).collect()
    expected = brute_contamination(list(enumerate(t for _, t in rows)), [(4, ITEM)])
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(repr((rows[i][0], *x)) for i, *x in expected)


@pytest.mark.parametrize("hot", [8000, 2])
def test_repeats_of_rows_without_id(llm, monkeypatch, hot):
    from milepost.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "SORTED", hot)
    rows = [(i if i % 3 else None, t) for i, t in enumerate(repeating(5))]
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(llm.createDataFrame(rows, "doc_id long, text string").repartition(3), 120)).collect()
    expected = suffix_dedup.brute_force([t for _, t in rows], 120)
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr((i, *x)) for (i, _), x in zip(rows, expected, strict=True))


def test_the_stage_drops_only_contaminated_rows(llm, tmp_path):
    import corpus_pipeline as pipeline

    llm.createDataFrame([(4, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, ITEM), (None, "clean"), (1, ITEM), (1, "one id, another text"), (2, long_text(5))]
    docs = llm.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    got = pipeline.decontamination(llm, docs, str(tmp_path)).collect()
    assert sorted(r["text"] for r in got) == sorted(["clean", "one id, another text", long_text(5)])
