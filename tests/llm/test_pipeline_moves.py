"""Which joins of the pipeline's stages move the texts."""

from conftest import long_text

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def test_texts_are_not_shuffled_to_drop_a_few_rows(llm, tmp_path):
    import corpus_pipeline as pipeline

    texts = [" ".join(f"{k}{i}" for i in range(30)) for k in "abc"] + [long_text(50)] * 2
    docs = llm.createDataFrame([(i, t, "en", "web", len(t)) for i, t in enumerate(texts)], KIND).repartition(3)
    llm.createDataFrame([(1, " ".join(f"b{i}" for i in range(5, 20)))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for step, left in ((pipeline.near_duplicates, [0, 1, 2, 3]), (pipeline.decontamination, [0, 2, 3, 4])):
        out = step(llm, docs, str(tmp_path))
        assert sorted(r["doc_id"] for r in out.collect()) == left
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
