"""The registered queries and the pipeline on the smallest tables."""

import os

import pytest
from compare import connect, differences

from milepost.llm import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(llm, name):
    assert differences(queries.QUERIES[name](llm, FOLDER), connect(FOLDER), queries.ORACLE[name]) == []


def test_queries_return_a_row_for_each_document(llm):
    n = llm.read.parquet(f"{FOLDER}/documents.parquet").count()
    for name in ("op1_token_counts", "op5_near_duplicates", "op6_suffix_dedup", "op7_sharding", "op9_language_id", "op10_sentencepiece"):
        assert queries.QUERIES[name](llm, FOLDER).count() == n, name


def test_pipeline_equals_its_steps(llm):
    """Against plain Python for what each stage keeps."""
    import sys

    from test_dedup import brute_contamination, brute_near

    import corpus_pipeline as pipeline
    from milepost.llm import suffix_dedup

    assert "test_dedup" in sys.modules and len(pipeline.STAGES) == 5
    rows = {r["doc_id"]: r["text"] for r in llm.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = {i: t for i, t in rows.items() if t and any(map(str.isalpha, t))}
    rows = {i: rows[i] for i, _, _, kept in brute_near(sorted(rows.items()), 5, 80) if kept}
    order = sorted(rows)
    spans = suffix_dedup.remove_repeats(llm.createDataFrame([(i, rows[i]) for i in order], "doc_id long, text string"), 400)
    check = {r[0]: tuple(r)[1:] for r in suffix_dedup.digest(spans).collect()}
    assert [check[i] for i in order] == suffix_dedup.brute_force([rows[i] for i in order], 400)
    for r in spans.collect():
        rows[r["doc_id"]] = bytes(r["kept"]).decode("utf-8", "ignore")
    items = [(r["item_id"], r["text"]) for r in llm.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {x[0] for x in brute_contamination(sorted(rows.items()), items) if x[5]}
    got = {r["doc_id"]: r["text"] for r in pipeline.run(llm, FOLDER).collect()}
    assert got == {i: t for i, t in rows.items() if i not in dirty}
