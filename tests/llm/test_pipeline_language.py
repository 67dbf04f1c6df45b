"""What the pipeline's first stage rejects."""

import random

LANGS = {"en": "the of and ing tion this with", "de": "der die und ung keit schön über"}
KIND = "doc_id long, text string, lang string, source string, n_chars long"
JUNK = ["x 12 ### 9", "qzxv wvkq jjqx zzkw vqxj", "%%% k", "xqzzvkw " * 20]
EMPTY = [None, "", "12 !! 34"]


def rows(lang):
    rng = random.Random(3)
    clean = [" ".join(rng.choice(LANGS[k].split()) for _ in range(25)) for k in [*LANGS] * 100]
    out = [(i, t, [*LANGS][i % 2]) for i, t in enumerate(clean)]
    out += [(10 * k, t, None) for k, t in enumerate([*JUNK, *EMPTY], 100)]
    return [(i, t, lang and own, "web", len(t or "")) for i, t, own in out], sorted(clean)


def test_scores_reject_junk_and_keep_all_clean_rows(llm):
    import corpus_pipeline as pipeline

    table, clean = rows("own")
    got = pipeline.language(llm, llm.createDataFrame(table, KIND).repartition(3), "").collect()
    assert sorted(r["text"] for r in got) == clean


def test_all_letters_pass_where_no_language_was_learned(llm):
    import corpus_pipeline as pipeline

    table, clean = rows(None)
    got = pipeline.language(llm, llm.createDataFrame(table, KIND).repartition(3), "").collect()
    assert sorted(r["text"] for r in got) == sorted([*clean, *JUNK])
