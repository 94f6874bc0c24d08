"""Pricing looks a value's words up once where it has no digits or signs that stand for letters."""

from linkloom.llm import secrets


def test_plain_values_are_looked_up_once():
    asked = []

    class Rank(dict):
        def get(self, key):
            asked.append(key)
            return super().get(key)

    rank = Rank(secrets._RANK)
    assert secrets.guess_bits("zvpassword", rank) == secrets.guess_bits("zvpassword")
    assert len(asked) == len({(i, j) for i in range(10) for j in range(i + 3, 11)})
    assert secrets.guess_bits("zvp4ssword", rank) == secrets.guess_bits("zvpassword") + 2.0
