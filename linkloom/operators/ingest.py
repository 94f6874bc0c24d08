"""Quarter filter and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.dates import Quarter
from linkloom.functions.text import is_identifier

# Exceptions and what they say, in the order of the tests.
DETAILS = {"missing_state": "State is required for matching.", "missing_business_name": "Business name is blank."}


# Fixed value: what the exception of a file without a source says.
UNMAPPED = "No source mapping matched the workbook filename."


def file_exceptions(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files without a source, files with one that lack columns) of `files` (source_file, source_code, missing)."""
    unmapped = files.where("source_code is null").select(F.lit("unmapped_source_file").alias("exception_type"), "source_file", F.lit(UNMAPPED).alias("detail"))
    lacking = files.where("source_code is not null and missing <> ''").select(F.lit("missing_required_columns").alias("exception_type"), "source_file", F.col("missing").alias("detail"))
    return unmapped, lacking


def in_quarter(rows: DataFrame, q: Quarter) -> DataFrame:
    return rows.where(F.col("origination_date").between(F.lit(q.start), F.lit(q.end)))


def with_reject(rows: DataFrame) -> DataFrame:
    """`rows` with reject: the first test that fails, or null."""
    return rows.withColumn("reject", F.when(F.col("state") == "", "missing_state").when(F.col("live_business_name") == "", "missing_business_name"))


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to match, exceptions)."""
    judged = with_reject(rows)
    details = F.create_map(*[F.lit(x) for kv in DETAILS.items() for x in kv])
    wrong = judged.where("reject is not null").select(F.col("reject").alias("exception_type"), "source_file", "source_row_number", "live_business_name", F.try_element_at(details, F.col("reject")).alias("detail"))
    return judged.where("reject is null").drop("reject"), wrong


def identifier_rejects(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items with a name, items whose name is only an identifier)."""
    flag = is_identifier(F.col("live_business_name"))
    return items.where(~flag), items.where(flag).withColumn("exception_type", F.lit("identifier_only_name"))


def all_exceptions(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
