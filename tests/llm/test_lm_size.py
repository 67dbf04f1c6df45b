"""The size of the registered language model."""


def test_the_hidden_state_is_not_cut():
    from milepost.llm import lm

    assert lm.HIDDEN == 24
