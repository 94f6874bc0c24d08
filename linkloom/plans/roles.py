"""The test tables in the roles of partner exports, candidates, history and truth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.collapse import collapsed, prepared
from linkloom.operators.match import prepared_candidates

ITEM = ["source_code", "state", "dedupe_name_key"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decorated(name: str, key: str):
    """A part's name as a business would write it."""
    n, k = F.col(name), F.col(key) % 5
    return F.when(k == 0, F.concat(n, F.lit(", L.L.C."))).when(k == 1, F.concat(F.lit("The "), n, F.lit(" Co"))).when(k == 2, F.concat(F.upper(n), F.lit(" (main)"))).when(k == 3, F.concat(n, F.lit(" & Partners dba "), n)).otherwise(n)


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with an odd key as live rows."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").where(key % 2 == 1).select(
        F.concat(F.lit("export-"), (key % 3).cast("string"), F.lit(".csv")).alias("source_file"),
        F.lit("Origination Detail").alias("source_sheet"),
        key.alias("source_row_number"),
        F.col("p_brand").alias("source_name"),
        F.col("p_brand").alias("source_code"),
        F.col("p_type").alias("state"),
        decorated("p_name", "p_partkey").alias("live_business_name"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 120).cast("int")).alias("origination_date"),
        F.col("p_retailprice").alias("disbursed_amount"),
        F.lpad((key % 50).cast("string"), 5, "0").alias("live_zip_code"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with an even key as candidates."""
    key = F.col("p_partkey")
    dollars = lambda x: F.format_number(F.floor(F.col("p_retailprice") * x), 0)
    frame = table(spark, sf_dir, "part").where(key % 2 == 0).select(
        key.alias("application_id"),
        key.alias("ordinal"),
        F.col("p_brand").alias("candidate_source"),
        decorated("p_name", "p_partkey").alias("crm_business_name"),
        F.when(key % 8 == 0, F.concat(F.lit("Ann "), F.col("p_name"))).alias("customer_first_name"),
        F.lit("").alias("customer_last_name"),
        F.lit(None).cast("string").alias("prescreen_first_name"),
        F.lit(None).cast("string").alias("prescreen_last_name"),
        F.when(key % 6 == 0, F.lit(" ")).otherwise(F.lower("p_type")).alias("business_state"),
        F.col("p_type").alias("prescreen_state"),
        F.lpad((key % 50).cast("string"), 5, "0").alias("business_zip_code"),
        F.concat(F.lit("$"), dollars(0.8), F.lit(" - $"), dollars(1.2)).alias("loan_range"),
        F.date_add(F.lit("2024-02-01").cast("date"), (key % 90).cast("int")).alias("lead_start_date"),
    )
    return prepared_candidates(frame)


def far_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidates, where those of the types that begin with S have moved to a state without items."""
    moved = F.col("candidate_state").startswith("S")
    return candidates(spark, sf_dir).withColumn("candidate_state", F.when(moved, F.lit("ELSEWHERE")).otherwise(F.col("candidate_state")))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapsed(prepared(live(spark, sf_dir)))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user and type as a history of matches."""
    e = table(spark, sf_dir, "events").where("user_id % 3 <> 0").groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"), F.min_by("value", "event_id").alias("value"))
    return e.select(
        F.sha1(F.concat_ws("||", F.col("user_id").cast("string"), "event_type").cast("binary")).alias("match_key"),
        F.when(F.col("event_id") % 4 == 0, "auto_accept").when(F.col("event_id") % 4 == 1, "review").otherwise("possible_match").alias("decision_band"),
        F.when(F.col("event_id") % 5 == 0, "confirmed").otherwise("new").alias("status"),
        F.lit("").alias("status_note"),
        F.when(F.col("event_id") % 3 == 0, "Approved").when(F.col("event_id") % 3 == 1, "OPEN").otherwise("Denied").alias("candidate_status"),
        F.col("value").alias("match_score"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("event_id") % 28 + 1).cast("string"), 2, "0")).alias("first_seen_at"),
        F.lit("2024-02-01").alias("last_seen_at"),
        F.lit("").alias("status_updated_at"),
        F.lit("2024Q1").alias("quarter_first_seen"),
        F.lit("run-1").alias("first_run_label"),
        F.lit("run-1").alias("last_run_label"),
        (F.col("event_id") % 7 + 1).alias("times_seen"),
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user and type as a run's matches."""
    e = table(spark, sf_dir, "events").where("user_id % 2 = 0").groupBy("user_id", "event_type").agg(F.max("event_id").alias("event_id"), F.max_by("value", "event_id").alias("value"))
    return e.select(
        F.sha1(F.concat_ws("||", F.col("user_id").cast("string"), "event_type").cast("binary")).alias("match_key"),
        F.when(F.col("event_id") % 2 == 0, "auto_accept").otherwise("review").alias("decision_band"),
        F.lit("InProgress").alias("candidate_status"),
        F.col("value").alias("match_score"),
    )


def truth(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(truth, predictions): labels are right answers, documents what was predicted."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("key"), F.when(F.col("quality") == 1, F.col("doc_id") % 7).alias("expected"), F.concat(F.lit("case_"), (F.col("doc_id") % 4).cast("string")).alias("case")
    )
    k = F.col("doc_id")
    predictions = table(spark, sf_dir, "documents").where(k % 9 != 0).select(
        k.alias("key"), F.when(k % 10 == 0, (k + 1) % 7).otherwise(k % 7).alias("application_id"), F.when(k % 3 == 0, "review").when(k % 11 == 0, "possible_match").otherwise("auto_accept").alias("decision_band")
    )
    return labels, predictions
