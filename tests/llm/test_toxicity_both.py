"""Votes and features of a text from one reading."""

import pytest

from posttags.llm import toxicity


@pytest.mark.parametrize("remember", [2, 300_000])
def test_both_in_one_reading(monkeypatch, remember):
    monkeypatch.setattr(toxicity, "REMEMBER", remember)
    voters, apart = (toxicity.Voters(["idiot", "mor*", "débile"]) for _ in range(2))
    for text in ["", "  ", "You IDIOT, you idiot!", "MORON LOUD", "a moral débile " * 3, "well enough " + "x1 " * 99, "é \U0001f600 --"]:
        votes, features = voters.both(text)
        assert votes == apart.packed(text)
        assert sorted(features) == sorted(apart.features(text)) and features.dtype == apart.features(text).dtype


def test_scoring_splits_a_text_once():
    class Counted(str):
        splits = 0

        def split(self, *args):
            Counted.splits += 1
            return super().split(*args)

    toxicity.Voters(["idiot"]).both(Counted("you idiot"))
    assert Counted.splits == 1
