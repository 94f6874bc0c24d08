"""Operators on values, texts and groups that were once cut."""

import random
import string
import time

import numpy as np
import pytest

from linkloom.llm import common, near_dups, secrets, toxicity


def slow_bits(value):
    """The same costs over every segment there is."""
    best = [0.0] + [float("inf")] * len(value)
    ending = {}
    for i, j, bits in secrets._segments(value):
        ending.setdefault(j, []).append((i, bits))
    for j in range(1, len(value) + 1):
        best[j] = min([best[j - 1] + secrets._alphabet(value[j - 1]), *(best[i] + bits + 1 for i, bits in ending.get(j, []))])
    return best[-1]


@pytest.mark.parametrize("n", [8, 63, 64, 65, 128, 192, 193, 256, 5_000])
def test_long_masks_are_no_secrets(n):
    for value in ("*" * n, ("xy" * n)[:n], ("wxyz" * n)[:n], ("=-" * n)[:n]):
        assert secrets.find_spans(f"pwd: {value} x".encode())[1] == []
        assert n > 300 or secrets.guess_bits(value) == pytest.approx(slow_bits(value))


def test_costs_are_those_of_all_segments():
    r = random.Random(4)
    pieces = ["aaaa", "1111111", "ababab", "abcabc", "qwerty", "0101010101", "password", "pass", "sss", "2000", "20001111", "***", "Ab", "x9", "zyx", "Hello", "aaab" * 3, "12" * 9]
    for _ in range(150):
        value = "".join(r.choices(pieces, k=r.randint(1, 25)))
        assert secrets.guess_bits(value) == pytest.approx(slow_bits(value)), value
    for _ in range(100):
        value = "".join(r.choices("ab12", k=r.randint(1, 130)))
        assert secrets.guess_bits(value) == pytest.approx(slow_bits(value)), value


def test_one_row_of_each_group_stays(spark):
    r = random.Random(6)
    texts = [" ".join(str(r.randrange(10**6)) for _ in range(40)) for _ in range(6)]
    a, b, c, d, e, f = texts
    rows = [(None, a, "x"), (None, b, "x"), (None, b, "x"), (None, b, "w"), (3, c, "x"), (3, d, "x"), (3, d, "x"), (None, e, "x"), (9, e, "x"), (4, e, "y"), (4, e, "z"), (None, None, "x"), (None, "", "x"), (7, f, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = [(3, c, "x"), (3, d, "x"), (4, e, "y"), (7, f, None), (None, "", "x"), (None, a, "x"), (None, b, "w")]
    for n in (1, 7):
        assert sorted(map(tuple, near_dups.one_of_each(docs.repartition(n)).collect()), key=repr) == sorted(want, key=repr)


def test_toxicity_of_the_pair_alone_is_learned():
    """Each of two words is as frequent with the label as without it; only together (or neither) they tell."""
    r = random.Random(2)
    texts, labels = [], []
    for i in range(1600):
        a, b = i % 2, i // 2 % 2
        texts.append(" ".join([*r.choices([f"w{i}" for i in range(30)], k=8), *["insult"] * a, *["group"] * b]))
        labels.append(float(a == b))
    machine = toxicity.fit([np.array(toxicity.terms(t.encode())) for t in texts], np.array(labels), 0.5)
    scores = machine.logits([toxicity.terms(t) for t in (b"insult group w1", b"insult w1", b"group w1", b"w1")])
    assert (scores > 0).tolist() == [True, False, False, True]


def hot_list(r, n):
    """n fingerprints that share four bytes, and some that share only three with them."""
    low = r.getrandbits(32)
    high = {r.getrandbits(32) for _ in range(n - n // 50)}
    high |= {x ^ 1 << r.randrange(32) for x in r.sample(sorted(high), n // 50)}
    prints = [h << 32 | low for h in high]
    return prints + [p ^ 0xFF << 24 for p in prints[:200]] + [p ^ 3 << 5 for p in prints[:200]]


def components_of(prints):
    x = np.array(sorted(prints), np.uint64)
    i, j = [], []
    for at in range(0, len(x), 500):
        a, b = np.nonzero(np.bitwise_count(x[at : at + 500, None] ^ x[None, at:]) <= 4)
        i.append(at + a)
        j.append(at + b)
    label = near_dups.stars(len(x), np.concatenate(i), np.concatenate(j))
    return x, label


@pytest.mark.parametrize(("n", "long_list"), [(3_000, 10), (20_000, near_dups.LONG_LIST)])
def test_hot_lists_lose_no_link(spark, n, long_list):
    prints = hot_list(random.Random(n), n)
    x, label = components_of(prints)
    shelf = common.Shelf(spark, "test")
    rows = spark.createDataFrame([(int(p),) for p in x.view(np.int64)], "fp long").repartition(6)
    found = near_dups.roots_of(rows, shelf, long_list).collect()
    groups, want = {}, {}
    for r in found:
        groups.setdefault(r.root, set()).add(r.fp)
    for p, k in zip(x.view(np.int64).tolist(), label.tolist(), strict=True):
        want.setdefault(k, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_the_tally_rejects_pairs_of_too_few_positions():
    x = np.array([0x0101010101000000, 0x0001010100000000, 0x0000000000000F00, 0], np.uint64)
    assert [near_dups.links(x, c, 3).tolist() for c in (0b111, 0b1101)] == [[False, True, False, True], [False, False, True, False]]


def test_stars_against_union_find():
    r = np.random.default_rng(1)
    for _ in range(50):
        n, m = 40, int(r.integers(0, 60))
        i, j = r.integers(0, n, m), r.integers(0, n, m)
        root = list(range(n))
        for _ in range(n):
            for a, b in zip(i.tolist(), j.tolist(), strict=True):
                root[a] = root[b] = min(root[a], root[b])
        assert near_dups.stars(n, i, j).tolist() == root


def test_long_runs_of_underscores_are_scanned_in_linear_time():
    start = time.process_time()
    assert secrets.find_spans(b"pass " + b"a_" * 500_000) == ([], [])
    blob = "".join(random.Random(1).choices(string.ascii_letters + string.digits, k=300_000))
    assert secrets.find_spans(f"login: {blob}".encode())[1] == [("guess", 7, 300_007)]
    assert secrets.find_spans(b"auth=" + b"xy" * 100_000) == ([], [])
    assert time.process_time() - start < 15


def test_stopping_early_decides_alike():
    r = random.Random(8)
    for _ in range(300):
        value = "".join(r.choices(["a", "b1", "Password", "qwerty", "2024", "x9", "zz", "*" * 30, "Kq", "#"], k=r.randint(1, 30)))
        assert (secrets.guess_bits(value, enough=40.0) >= 40) == (secrets.guess_bits(value) >= 40), value


def test_words_come_from_the_texts_without_their_secrets(spark):
    rows = [(i, f"Ordinary prose speaks plainly. password = zebraquilt{i % 2} and more") for i in range(30)] + [(99, None), (100, "")]
    rank = secrets.learned_words(spark.createDataFrame(rows, "id int, text string"), least=20)
    assert "plainly" in rank and "zebraquilt" not in rank and rank["password"] == 1
    assert secrets.guess_bits("ordinaryplainly", rank) < secrets.GUESS_BITS <= secrets.guess_bits("ordinaryplainly")


def test_precision_and_recall_of_guesses():
    r = random.Random(12)
    lexicon = secrets.ranked([f"{a}{b}{c}" for a in ("ba", "ko", "mi", "ter", "sun", "ral") for b in ("ra", "ne", "tol", "vi", "su") for c in ("n", "s", "ka", "der", "")])
    words = list(lexicon)
    strong = ["".join(r.choices(string.ascii_letters + string.digits + "!#$%&*+-", k=r.randint(10, 24))) for _ in range(400)]
    weak = [r.choice(words) + r.choice(words) for _ in range(100)] + [r.choice(words).title() + str(r.randrange(1970, 2030)) for _ in range(100)]
    weak += [r.choice(words) * r.randint(3, 9) for _ in range(100)] + ["qwertyuiop"[: r.randint(8, 10)] + str(r.randrange(1000)) for _ in range(100)]
    weak = [w for w in weak if len(w) >= 8]
    found = [v for v in strong + weak if secrets.find_spans(f"pwd: {v} ".encode(), rank=lexicon)[1]]
    hits = len(set(found) & set(strong))
    assert hits / len(strong) > 0.97 and hits / len(found) > 0.97
