import pytest


@pytest.fixture(scope="session")
def llm(spark):
    """The session with what the operators' queries set."""
    from milepost.llm.queries import prepared

    return prepared(spark)


def long_text(n):
    return " ".join(f"word{i * 7919 % 1013}" for i in range(n))


#: Nulls, empty and blank texts, one word, ties, repeated rows, other scripts, a very long text.
TEXTS = [
    None, "", "   \n\t ", "one", "One", "the cat sat on the mat", "The cat  sat\non the mat", "the cat sat on the hat", "a<|endoftext|>b", "x" * 3000,
    "¡Señor! über straße, 日本語 テキスト ▁ é", "12345 !!! ###", long_text(40), long_text(40) + " tail", "pre " + long_text(40), long_text(30), long_text(6000), "\x00\x01 nul",
    "ab " * 400, "ab " * 401, "\U0001f600 smile", "the cat sat on the mat", None,
]


@pytest.fixture
def texts():
    return TEXTS


@pytest.fixture
def documents(llm):
    """The texts with columns that clash with names the operators use."""
    rows = [(i, t, "en", f"s{i}", i, "x", 1.0) for i, t in enumerate(TEXTS)]
    rows += [rows[7], rows[12]]  # repeated rows
    return llm.createDataFrame(rows, "doc_id long, text string, id string, spans string, n int, kept string, score double").repartition(3)


@pytest.fixture
def nothing(llm):
    return llm.createDataFrame([], "doc_id long, text string, lang string")
