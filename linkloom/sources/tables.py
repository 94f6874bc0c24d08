"""Sources: partner exports, candidates from CSV, Parquet or a database, decisions and truth."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of a partner's export.
REQUIRED = ["Business Name", "State", "Origination Date", "$ disbursed"]

_S, _L, _D = T.StringType(), T.LongType(), T.DateType()
CANDIDATE = T.StructType(
    [T.StructField(c, _L) for c in ("application_id", "business_id", "customer_id")]
    + [T.StructField(c, _S) for c in ("candidate_source", "candidate_source_name", "application_status", "loan_range")]
    + [T.StructField(c, _D) for c in ("application_created_date", "lead_start_date", "prescreen_created_date")]
    + [T.StructField(c, _S) for c in ("crm_business_name", "customer_first_name", "customer_last_name", "business_state", "business_zip_code", "prescreen_first_name", "prescreen_last_name", "prescreen_state", "prescreen_zip_code", "prescreen_business_zip_code")]
)


def text_or_blank(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def code(c: Column) -> Column:
    return F.upper(text_or_blank(c))


def missing_columns(columns: list[str]) -> list[str]:
    return [c for c in REQUIRED if c not in columns]


def origination_sheet(sheets: list[str]) -> str:
    """The first sheet with "origination" in its name."""
    for s in sheets:
        if "origination" in s.lower():
            return s
    raise ValueError("no origination sheet")


def live_rows(export: DataFrame) -> DataFrame:
    """Rows of an export with source_file, source_sheet and source_row_number, coerced."""
    zips = F.regexp_replace(text_or_blank(F.col("`Zip Code`")), r"\.0$", "") if "Zip Code" in export.columns else F.lit("")
    return export.select(
        "source_file",
        "source_sheet",
        F.col("source_row_number").cast("bigint").alias("source_row_number"),
        text_or_blank(F.col("`Business Name`")).alias("live_business_name"),
        code(F.col("State")).alias("state"),
        F.to_date(F.try_to_timestamp(F.col("`Origination Date`").cast("string"))).alias("origination_date"),
        F.col("`$ disbursed`").cast("string").try_cast("double").alias("disbursed_amount"),
        zips.alias("live_zip_code"),
    )


@dataclass(frozen=True)
class ExportFile:
    """A sheet's file: its path (as a URI), workbook, sheet and header."""

    path: str
    uri: str
    source_file: str
    source_sheet: str
    header: tuple[str, ...]


def _listed(spark: SparkSession, path: str):
    """(filesystem, statuses below `path` in order of their names, hidden ones aside)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [x for x in files.listStatus(at) if not x.getPath().getName().startswith(("_", "."))] if files.exists(at) else []
    return files, sorted(found, key=lambda x: x.getPath().getName())


def _header(spark: SparkSession, files, path) -> tuple[str, ...]:
    """The first record of a CSV file; a null file has no columns."""
    stream = spark.sparkContext._jvm.java.io.BufferedReader(spark.sparkContext._jvm.java.io.InputStreamReader(files.open(path), "UTF-8"))
    try:
        first = stream.readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([first.lstrip("\ufeff")]))) if first else ()


def _one_slash(uri):
    """Spark and Hadoop write `file:///a` and `file:/a` for the same file."""
    return re.sub("^([^:/]+):/+", r"\1:/", uri) if isinstance(uri, str) else F.regexp_replace(uri, "^([^:/]+):/+", "$1:/")


def _export_file(spark: SparkSession, files, at, source_file: str, sheet: str) -> ExportFile:
    return ExportFile(at.toString(), _one_slash(at.toUri().toString()), source_file, sheet, _header(spark, files, at))


def export_files(spark: SparkSession, path: str) -> list[ExportFile]:
    """The CSV files of a folder of exports: `<workbook>.csv`, or `<workbook>/<sheet>.csv`, of which the origination sheet counts."""
    files, found = _listed(spark, path)
    out = []
    for x in found:
        name = x.getPath().getName()
        if x.isDirectory():
            sheets = {y.getPath().getName().removesuffix(".csv"): y.getPath() for y in _listed(spark, x.getPath().toString())[1]}
            sheet = origination_sheet(sorted(sheets))
            out.append(_export_file(spark, files, sheets[sheet], name, sheet))
        elif name.endswith(".csv"):
            out.append(_export_file(spark, files, x.getPath(), name, name.removesuffix(".csv")))
    return out


def numbered(rows: DataFrame, first: int = 2) -> DataFrame:
    """`rows` as read from files, with source_row_number, the place in the file; the header is row 1.

    Rows are numbered within each split of a file as they are read, and the rows of the splits before are added.
    """
    names = [f.name for f in rows.schema]
    marked = rows.select(*[F.col(f"`{c}`") for c in names], F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"))
    splits = marked.groupBy("__path", "__block").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__path").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    starts = splits.select("__path", "__block", "__first", F.coalesce(before, F.lit(0)).alias("__before"))
    number = F.col("__id") - F.col("__first") + F.col("__before") + first
    return marked.join(starts, ["__path", "__block"]).select(*[F.col(f"`{c}`") for c in names], "__path", number.alias("source_row_number"))


def read_exports(spark: SparkSession, files: list[ExportFile]) -> DataFrame:
    """The rows of exports with source_file, source_sheet and source_row_number.

    Files with the same header are read together, each by its own header, and their columns meet by name; those
    that a file lacks are null there.
    """
    groups: dict[tuple[str, ...], list[ExportFile]] = defaultdict(list)
    for f in files:
        groups[f.header].append(f)
    parts = []
    for header, own in groups.items():
        if not header:
            continue
        kinds = T.StructType([T.StructField(c or f"_c{i}", _S) for i, c in enumerate(header)])
        rows = numbered(spark.read.schema(kinds).option("header", True).option("enforceSchema", True).csv([f.path for f in own]))
        places = spark.createDataFrame([(f.uri, f.source_file, f.source_sheet) for f in own], "__uri string, source_file string, source_sheet string")
        parts.append(rows.join(places, _one_slash(F.col("__path")) == F.col("__uri")).drop("__path", "__uri"))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*REQUIRED, "source_file", "source_sheet"]) + ", source_row_number bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidates of a CSV file whose columns may stand in any order; columns that it lacks are null."""
    raw = spark.read.csv(path, header=True)
    known = {f.name: F.col(f.name) if f.name in raw.columns else F.lit(None) for f in CANDIDATE}
    ids = {f.name: known[f.name].try_cast("bigint") for f in CANDIDATE if f.dataType == _L}
    return coerced_candidates(raw.select(*[(ids.get(f.name, known[f.name].cast("string"))).alias(f.name) for f in CANDIDATE]))


def coerced_candidates(frame: DataFrame) -> DataFrame:
    """Dates coerced and codes in upper case, for the columns that are there."""
    dates = {c: F.to_date(F.try_to_timestamp(F.col(c).cast("string"))) for c in ("application_created_date", "lead_start_date", "prescreen_created_date") if c in frame.columns}
    codes = {c: code(F.col(c)) for c in ("candidate_source", "business_state", "prescreen_state") if c in frame.columns}
    return frame.withColumns(dates | codes)


def identifier(name: str) -> str:
    """A schema's name, checked before it is used in SQL."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_$]*", name):
        raise ValueError(f"not an identifier: {name!r}")
    return name


TABLES = ("lead", "organization", "source", "person", "location", "screening")


def database_tables(spark: SparkSession, url: str, schema: str, **options: str) -> dict[str, DataFrame]:
    """The tables that candidates come from, over JDBC."""
    schema = identifier(schema)
    return {t: spark.read.format("jdbc").options(url=url, dbtable=f'"{schema}".{t}', **options).load() for t in TABLES}


def extract_candidates(lead: DataFrame, organization: DataFrame, source: DataFrame, person: DataFrame, location: DataFrame, screening: DataFrame) -> DataFrame:
    """One row of CANDIDATE columns for each screened lead with an organization.

    Where there are several business locations or screenings the newest count, nulls last; ties go to the
    smallest organization, then to the first region and names. A lead's locations and screenings meet each with
    each, so that the newest pair is that of the newest of either: they are chosen before they are joined.
    """
    place = location.where("location_type = 'BUSINESS'").select("organization_id", F.col("region").alias("business_state"), F.col("postal_code").alias("business_zip_code"), F.col("created_at").alias("location_created_at"))
    seen = screening.select(
        "lead_id", F.col("created_at").alias("prescreen_created_date"), F.col("first_name").alias("prescreen_first_name"), F.col("last_name").alias("prescreen_last_name"),
        F.col("region").alias("prescreen_state"), F.col("postal_code").alias("prescreen_zip_code"), F.col("org_postal_code").alias("prescreen_business_zip_code"),
    )
    leads = lead.where("stage = 'SCREENED'").select("lead_id", "source_code", F.col("status").alias("application_status"), F.col("size_band").alias("loan_range"), F.col("created_at").alias("application_created_date"), "opened_at")
    joined = (
        leads.join(organization.select("organization_id", "lead_id", F.col("name").alias("crm_business_name"), "person_id"), "lead_id")
        .join(source.select(F.col("code").alias("source_code"), F.col("display_name").alias("candidate_source_name")), "source_code", "left")
        .join(person.select("person_id", F.col("first_name").alias("customer_first_name"), F.col("last_name").alias("customer_last_name")), "person_id", "left")
        .join(latest(place, ["organization_id"], ["location_created_at"], ["business_state", "business_zip_code"]), "organization_id", "left")
        .join(latest(seen, ["lead_id"], ["prescreen_created_date"], ["prescreen_first_name", "prescreen_last_name", "prescreen_zip_code"]), "lead_id", "left")
    )
    named = joined.withColumnsRenamed({"lead_id": "application_id", "organization_id": "business_id", "person_id": "customer_id", "source_code": "candidate_source"})
    dated = named.withColumn("lead_start_date", F.coalesce("prescreen_created_date", "opened_at", "application_created_date"))
    ties = ["business_id", "business_state", "business_zip_code", "prescreen_first_name", "prescreen_last_name", "prescreen_zip_code"]
    return latest(dated, ["application_id"], ["location_created_at", "prescreen_created_date"], ties).select(*[f.name for f in CANDIDATE])


def latest(frame: DataFrame, key: list[str], newest: list[str], ties: list[str] | None = None) -> DataFrame:
    """The first row of each key by `newest` descending, nulls last, then by `ties`."""
    order = [F.col(c).desc_nulls_last() for c in newest] + [F.col(c).asc_nulls_last() for c in ties or []]
    return frame.withColumn("__nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__nth = 1").drop("__nth")


def mapped_sources(files: DataFrame, mappings: DataFrame) -> DataFrame:
    """`files` (source_file) with the first mapping (place, source_code, marker) whose marker is in the name, null without one.

    The mappings are settings, a few rows.
    """
    hit = F.contains(F.lower("source_file"), F.lower("marker"))
    both = files.join(F.broadcast(mappings), hit, "left")
    return both.groupBy("source_file").agg(F.min_by("source_code", "place").alias("source_code"))


def decisions_of(report: DataFrame) -> DataFrame:
    """(match_key, status, status_note) of a report's section; none if it lacks a key or a status."""
    if not {"match_key", "status"} <= set(report.columns):
        return report.sparkSession.createDataFrame([], "match_key string, status string, status_note string")
    note = F.col("status_note").cast("string") if "status_note" in report.columns else F.lit("")
    return report.select(F.col("match_key").cast("string").alias("match_key"), F.col("status").cast("string").alias("status"), note.alias("status_note"))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """Labelled truth of a CSV file; a blank expected_application_id says that no match is right."""
    raw = spark.read.csv(path, header=True)
    return truth_rows(raw)


def truth_rows(raw: DataFrame) -> DataFrame:
    expected = F.col("expected_application_id").cast("string").try_cast("double").cast("bigint")
    return raw.select("source_code", "live_business_name", "state", expected.alias("expected"), "case")


def discovered_quarters(rows: DataFrame, most: str | None = None) -> DataFrame:
    from linkloom.functions.dates import quarter_label

    labels = rows.where("origination_date is not null").select(quarter_label(F.col("origination_date")).alias("quarter")).distinct()
    return (labels.where(F.col("quarter") <= most) if most else labels).orderBy("quarter")
