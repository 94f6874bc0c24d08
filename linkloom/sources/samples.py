"""Made-up exports and candidates of any size, for trials; the same seed gives the same rows on any cluster.

Each business has a candidate and a live row that differs from it as `case` says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CASES = ["clean", "legal_suffix", "dba", "transposed", "cross_state", "abbreviation", "misspelling", "stopword_trap", "no_counterpart"]
_FIRST = ["Amber", "Birch", "Cobalt", "Drift", "Ember", "Fern", "Granite", "Hazel", "Indigo", "Juniper", "Kelp", "Lark"]
_SECOND = ["Anvil", "Beacon", "Canyon", "Dune", "Estuary", "Forge", "Grove", "Hollow", "Inlet", "Jetty", "Knoll", "Lagoon"]
_TRADE = ["Bakery", "Carpentry", "Dairy", "Foundry", "Garage", "Nursery", "Pottery", "Tannery"]
_STATES = ["OR", "WI", "AZ", "VA"]


def _pick(words: list[str], h: Column, salt: int) -> Column:
    listed = F.split(F.lit(",".join(words)), ",")
    return F.get(listed, F.pmod(F.xxhash64(h, F.lit(salt)), F.lit(len(words))).cast("int"))


def businesses(spark: SparkSession, n: int, seed: int = 1) -> DataFrame:
    k = F.col("id")
    return spark.range(n).select(
        k.alias("number"),
        _pick(_FIRST, k, seed).alias("first"),
        _pick(_SECOND, k, seed + 1).alias("second"),
        _pick(_TRADE, k, seed + 2).alias("trade"),
        _pick(_STATES, k, seed + 3).alias("state"),
        F.lpad(F.pmod(F.xxhash64(k, F.lit(seed + 4)), F.lit(99999)).cast("string"), 5, "0").alias("zip"),
        (F.pmod(F.xxhash64(k, F.lit(seed + 5)), F.lit(200)) * 1000 + 5000).cast("double").alias("amount"),
        _pick(CASES, k, seed + 6).alias("case"),
    )


def live_rows(made: DataFrame) -> DataFrame:
    name, k = F.concat_ws(" ", "first", "second", "trade"), F.col("case")
    written = (
        F.when(k == "legal_suffix", F.concat(name, F.lit(", L.L.C.")))
        .when(k == "dba", F.concat(F.col("first"), F.lit(" Holdings LLC dba "), name))
        .when(k == "transposed", F.concat_ws(" ", "second", "first", "trade"))
        .when(k == "abbreviation", F.concat(F.substring("first", 1, 2), F.lit(" "), F.col("second"), F.lit(" "), F.col("trade")))
        .when(k == "misspelling", F.concat(F.replace("first", F.lit("e"), F.lit("i")), F.lit(" "), F.col("second"), F.lit(" "), F.col("trade")))
        .when(k == "stopword_trap", F.lit("Capital Investment Group"))
        .otherwise(F.concat(name, F.lit(" LLC")))
    )
    return made.select(
        F.lit("sample.csv").alias("source_file"), F.lit("Origination Detail").alias("source_sheet"), (F.col("number") + 2).alias("source_row_number"), F.lit("Sample").alias("source_name"), F.lit("SMP").alias("source_code"),
        written.alias("live_business_name"), "state", F.date_add(F.lit("2026-04-01").cast("date"), F.pmod("number", F.lit(60)).cast("int")).alias("origination_date"), F.col("amount").alias("disbursed_amount"), F.col("zip").alias("live_zip_code"),
    )


def candidates(made: DataFrame) -> DataFrame:
    dollars = lambda x: F.format_number(F.floor(F.col("amount") * x), 0)
    name = F.when(F.col("case") == "stopword_trap", "Capital Ventures Group").otherwise(F.concat_ws(" ", "first", "second", "trade"))
    blank = F.lit(None).cast("string")
    return made.where("case <> 'no_counterpart'").select(
        F.col("number").alias("application_id"), F.lit("SMP").alias("candidate_source"), F.lit("OPEN").alias("application_status"), name.alias("crm_business_name"), F.col("state").alias("business_state"), F.col("zip").alias("business_zip_code"),
        F.concat(F.lit("$"), dollars(0.6), F.lit(" - $"), dollars(1.6)).alias("loan_range"), F.lit("2026-02-01").cast("date").alias("lead_start_date"),
        *[blank.alias(c) for c in ("customer_first_name", "customer_last_name", "prescreen_first_name", "prescreen_last_name", "prescreen_state")],
    )
