"""Repeated live rows become one item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.text import first_variant, is_identifier, name_variants, stable_hash

ORDER = ("source_file", "source_row_number")


def prepared(rows: DataFrame) -> DataFrame:
    """`rows` with variants, dedupe key, identifier flag and record key."""
    amount = F.replace(F.format_number("disbursed_amount", 2), F.lit(","), F.lit(""))
    return (
        rows.withColumn("live_name_variants", name_variants(F.col("live_business_name")))
        .withColumn("dedupe_name_key", first_variant(F.col("live_name_variants")))
        .withColumn("is_identifier_only", is_identifier(F.col("live_business_name")))
        .withColumn("live_record_key", stable_hash(F.col("source_code"), F.col("state"), F.col("dedupe_name_key"), F.date_format("origination_date", "yyyy-MM-dd"), amount))
    )


def _first(name: str) -> Column:
    """The first value that is not null, in the rows' order."""
    at = F.when(F.col(name).isNotNull(), F.struct(*ORDER))
    return F.min_by(name, at).alias(name)


def _in_order(name: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(*ORDER, F.col(name).alias("x")))), lambda r: r["x"])


def collapsed(rows: DataFrame) -> DataFrame:
    """One item for each source, state and dedupe key of prepared rows."""
    amounts = F.array_sort(F.collect_set("disbursed_amount"))
    return rows.groupBy("source_code", "state", "dedupe_name_key").agg(
        *[_first(c) for c in ("source_name", "live_business_name", "live_name_variants", "is_identifier_only", "live_record_key")],
        F.array_join(F.array_sort(F.collect_set("source_file")), "; ").alias("source_files"),
        F.array_join(F.array_sort(F.collect_set("source_sheet")), "; ").alias("source_sheets"),
        F.array_join(F.transform(_in_order("source_row_number"), lambda n: n.cast("string")), ", ").alias("source_row_numbers"),
        F.array_join(F.array_sort(F.collect_list(F.date_format("origination_date", "yyyy-MM-dd"))), "; ").alias("origination_dates"),
        F.min("origination_date").alias("primary_origination_date"),
        F.array_join(F.transform(amounts, lambda x: F.format_number(x, 2)), "; ").alias("origination_amounts"),
        F.coalesce(F.sum("disbursed_amount"), F.lit(0.0)).alias("primary_origination_amount"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.trim("live_zip_code") != "", F.col("live_zip_code")))), "; ").alias("live_zip_codes"),
        F.count("*").alias("duplicate_count"),
    )


def duplicates(items: DataFrame) -> DataFrame:
    return items.where("duplicate_count > 1")
