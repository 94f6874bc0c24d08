"""Folding and normalising, by values and by the steps that long texts pay for."""

import re
import unicodedata

from pyspark.sql import functions as F

from linkloom.functions import text as t


def steps(column):
    return column._jc.toString()


def test_folding_looks_for_wide_characters_only_in_what_the_table_leaves(spark):
    texts = ["", "plain", "é", "naïve ﬃ ½ ǳ", "🄀 ﷲ Ⅺ ₨ x", "漢字 ½ 漢字 Ｆ", "ß́ á", None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = [r.y for r in rows.select("i", t.ascii_fold(F.col("x")).alias("y")).orderBy("i").collect()]
    assert got == [None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode() for x in texts]
    assert "regexp_extract_all(regexp_replace(" in steps(t.ascii_fold(F.col("x")))


def test_punctuation_of_folded_texts_is_translated(spark):
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} c" for c in range(0x80) if chr(c) not in "().4u&+"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = [r.y for r in rows.select("i", t.normalize(F.col("x")).alias("y")).orderBy("i").collect()]
    assert got == [" ".join(re.sub(r"[^\w\s&+]|[\x1c-\x1f]", " ", x.lower(), flags=re.ASCII).split()) for x in texts]
    assert r"[^\w\s&+]" not in steps(t.normalize(F.col("x")))
