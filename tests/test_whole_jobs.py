"""Queries over all of their rows, against their SQL with its filters taken out."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from linkloom.operators import adjudicate
from linkloom.plans import catalog

TABLES = "/root/testdata/sf0.01"
here = pytest.mark.skipif(not Path(TABLES).exists(), reason="the test tables are not here")


def plain(row):
    return tuple(round(x, 6) if isinstance(x, float) else x for x in row)


def from_sql(name):
    """What the SQL of `name` gives, in the order of its columns."""
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for table in Path(TABLES).glob("*.parquet"):
        where = f"{table}/*.parquet" if table.is_dir() else table
        db.execute(f"CREATE VIEW {table.stem} AS FROM read_parquet('{where}')")
    found = db.execute(catalog.ORACLES[name])
    return [x[0] for x in found.description], sorted(map(plain, found.fetchall()))


def same_as_sql(df, name):
    columns, want = from_sql(name)
    assert sorted(map(plain, df.select(*columns).collect())) == want
    return want


@here
@pytest.mark.parametrize("name", ["q_token_jaccard", "q_indel_ratio", "q_token_sort_ratio", "q_token_set_ratio", "q_partial_ratio", "q_indel_ratio_native", "q_name_score", "q_name_signal_guard"])
def test_similarities_see_all_pairs_of_the_blocks(spark, name):
    pairs = catalog.QUERIES[name](spark, TABLES)
    assert pairs.where(F.substring("a", 1, 1) != F.substring("b", 1, 1)).count() > 4096
    same_as_sql(pairs, name)


@here
def test_stub_adjudication_asks_about_all_items(spark):
    name = "q_stub_adjudication"
    assert len(same_as_sql(catalog.QUERIES[name](spark, TABLES), name)) > adjudicate.MOST_ROWS


def test_what_lies_beyond_the_cap_is_given(spark):
    rows = spark.createDataFrame([(i, "p", [7, 8]) for i in range(5)], "k int, prompt string, offered array<bigint>")
    for most, rest in ((3, [3, 4]), (9, []), (None, [])):
        asked = [r.k for r in adjudicate.asked(rows, adjudicate.Stub("top"), ["k"], most=most).collect()]
        assert sorted(r.k for r in adjudicate.unasked(rows, ["k"], most).collect()) == rest
        assert sorted([*asked, *rest]) == [0, 1, 2, 3, 4]
