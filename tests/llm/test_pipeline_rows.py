"""Stages of the pipeline on rows that an id doesn't tell apart."""

from conftest import long_text

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def table(llm, rows):
    return llm.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], KIND).repartition(3)


def test_one_row_of_each_class_stays_and_keeps_its_text(llm):
    import corpus_pipeline as pipeline

    long = long_text(100)  # over 400 bytes, so that two copies would erase each other
    other, third, fourth = (" ".join(f"{k}{i * 31 % 97}" for i in range(120)) for k in "xyz")
    rows = [
        (5, long), (5, long), (9, long),  # repeated rows and a copy
        (None, other), (7, other),  # a copy without id
        (None, third), (None, third),  # copies without any id
        (1, long + " tail"), (1, fourth),  # one id with two texts, one of them a near copy
        (8, fourth),
    ]
    kept = pipeline.near_duplicates(llm, table(llm, rows), "").localCheckpoint()
    expected = [(1, fourth), (1, long + " tail"), (7, other), (None, third)]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(expected, key=repr)
    got = pipeline.repeats(llm, kept, "").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(expected, key=repr)
