import pytest
from pyspark.sql import functions as F

from linkloom.functions import similarity as s
from linkloom.functions import text as t


def each(spark, values, of):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r.y for r in rows.select("i", of(F.col("x")).alias("y")).orderBy("i").collect()]


def test_normalize(spark):
    cases = {
        "  ACME/Beta, Inc.  ": "acme beta inc", "Cuts 4 U": "cuts for you", "Smith & Sons": "smith and sons", "A + B": "a and b", "Acme Corp (formerly Beta)": "acme corp",
        "Café Motörhead": "cafe motorhead", "X, L.L.C.": "x llc", "under_score": "under_score", "": "", None: "", "ﬁne ½ Łódź": "fine 12 odz", "A.B.": "ab", "Xa.b. c": "xa b c",
    }
    assert each(spark, list(cases), t.normalize) == list(cases.values())


def test_suffixes_and_stopwords(spark):
    names = ["Harbor Point Marine LLC", "Harbor Point Marine, L.L.C.", "acme pllc", "Co Op Market"]
    assert each(spark, names, t.strip_legal_suffixes) == ["harbor point marine", "harbor point marine", "acme", "op market"]
    assert each(spark, ["cedar consulting group services"], t.remove_stopwords) == ["cedar"]
    assert each(spark, ["Capital Investment Group"], t.core) == [""]
    assert each(spark, ["Cedar Consulting Group LLC"], t.significant_tokens) == [["cedar"]]


def test_trading_names(spark):
    parts = each(spark, ["Kestrel Holdings LLC dba Kestrel Coffee", "A doing business as B Diner", "Acme Diner", "é dbaé x", None], t.split_trading_names)
    assert parts[0][1:] == ["Kestrel Holdings LLC", "Kestrel Coffee"]
    assert parts[1][1:] == ["A", "B Diner"]
    assert parts[2:] == [["Acme Diner"], ["é dbaé x"], []]


def test_variants(spark):
    out = each(spark, ["Kestrel Holdings LLC dba Cuts 4 U", None, "nan", " NaN ", "The Group"], t.name_variants)
    assert out[0] == ["kestrel holdings llc dba cuts for you", "kestrel holdings dba cuts for you", "kestrel dba cuts for you", "kestrel holdings llc", "kestrel holdings", "kestrel", "cuts for you"]
    assert out[1:] == [[], [], [], ["the group"]]


def test_identifier_and_hash(spark):
    assert each(spark, ["A100234", "100234", "#100234", "Acme Diner", "Studio 54 Salon", "A-100234"], t.is_identifier) == [True, True, True, False, False, False]
    h = spark.range(1).select(t.stable_hash(F.lit("a"), F.lit("b")).alias("ab"), t.stable_hash(F.lit("b"), F.lit("a")).alias("ba"), t.stable_hash(F.lit(None), F.lit("a")).alias("na"), t.stable_hash(F.lit(""), F.lit("a")).alias("ea")).first()
    assert h.ab != h.ba and h.na == h.ea


@pytest.mark.parametrize(
    ("raw", "low", "high"),
    [("$10,000 - $50,000", 10000.0, 50000.0), ("$100,000+", 100000.0, float("inf")), (None, None, None), ("not a range", None, None), ("10 months", 1e7, 1e7), ("100k", 1e5, 1e5)],
)
def test_size_band(spark, raw, low, high):
    band = each(spark, [raw], t.size_band)[0]
    assert (band.low, band.high) == (low, high)


def test_scrub(spark):
    out = each(spark, ["key sk-ant-abc_1 and bearer XY.z x-api-key: q1 " + "z" * 700], t.scrub)[0]
    assert out.startswith("key [redacted-api-key] and Bearer [redacted] x-api-key: [redacted] z") and len(out) == 600


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_lcs_against_plain_table():
    import random

    r = random.Random(1)
    for _ in range(500):
        a, b = ("".join(r.choices("abc d", k=r.randint(0, 70))) for _ in range(2))
        assert s.lcs(a, b) == plain_lcs(a, b)
        assert s.partial_ratio(a, b) == s.partial_ratio(b, a)


def test_native_lcs_agrees(spark):
    pairs = [("kitten sitting", "sitting kitten"), ("abcbdab", "bdcaba"), ("", "a"), ("a", ""), ("", "")]
    rows = spark.createDataFrame(pairs, "a string, b string")
    assert [r.n for r in rows.select(s.lcs_native(F.col("a"), F.col("b")).alias("n")).collect()] == [s.lcs(a, b) for a, b in pairs] == [9, 4, 0, 0, 0]


def test_score_by_hand():
    a, b = "nw ironwood supply", "northwest ironwood supply"
    assert round(s.ratio(a, b), 2) == 83.72 and round(s.token_set_ratio(a, b), 2) == 90.91 and round(s.partial_ratio(a, b), 2) == 94.12
    assert round(s.variant_score(a, b), 2) == 86.59


def test_score_edges():
    assert s.ratio("", "") == 100 and s.ratio("", "a") == 0 and s.token_set_ratio("", "a") == 0 and s.token_set_ratio("a b", "a") == 100
    assert s.best_pair((), ("a",)) == (0.0, "", "") and s.best_pair(("x", "a"), ("a", "x"))[1:] == ("x", "x")


@pytest.mark.parametrize(
    ("a", "b", "score", "signal"),
    [("ironwood cabinetry", "cabinetry ironwood", 95.0, True), ("capital investment group", "capital ventures group", 78.0, False), ("harborpoint marine", "harbor point marine", 90.0, True), ("cedar bakery", "cedar bakery downtown", 88.0, True)],
)
def test_name_signal(a, b, score, signal):
    assert s.has_name_signal(a, b, score) is signal
