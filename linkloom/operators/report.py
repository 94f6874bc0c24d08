"""What a run writes: sections, summary and run state."""

from __future__ import annotations

import json
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.sources.tables import decisions_of

# Parts of the names of columns that are never written.
SENSITIVE = ["email", "phone", "ssn", "address_line", "date_of_birth", "dob"]
# Columns of matches that stand first, in this order.
PRIORITY = [
    "status", "status_note", "crm_source_name", "source_name", "crm_business_name", "live_business_name", "match_score", "primary_origination_date",
    "primary_origination_amount", "candidate_application_id", "origination_amounts", "application_created_date", "match_key",
]
# Sections in their order, those that are written only if they have rows, and those whose decisions are read back.
SECTIONS = ["summary", "auto_accept", "review", "possible_matches", "review_overflow", "exceptions", "duplicates", "not_surfaced"]
IF_ANY = ["review_overflow", "not_surfaced"]
DECIDED = ["auto_accept", "review", "possible_matches"]
# Fixed value: the name of the report that reviewers work on.
CURRENT = "match_review_current"


def without_sensitive(frame: DataFrame) -> DataFrame:
    return frame.drop(*[c for c in frame.columns if any(s in c.lower() for s in SENSITIVE)])


def in_report_order(frame: DataFrame) -> DataFrame:
    front = [c for c in PRIORITY if c in frame.columns]
    return frame.select(*front, *[c for c in frame.columns if c not in front])


def without_zone(frame: DataFrame) -> DataFrame:
    return frame.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in frame.schema if isinstance(f.dataType, T.TimestampType)})


def report_path(folder: str) -> str:
    return f"{folder}/{CURRENT}"


def write_report(path: str, sections: dict[str, DataFrame], format: str = "parquet") -> list[str]:
    """A folder for each section; the names of those written. Matches have their first columns in order."""
    written = []
    for name in SECTIONS:
        if name not in sections or name in IF_ANY and sections[name].isEmpty():
            continue
        clean = without_zone(without_sensitive(sections[name]))
        frame = in_report_order(clean) if name in (*DECIDED, "review_overflow") else clean
        frame.write.mode("overwrite").format(format).option("header", True).save(f"{path}/{name}")
        written.append(name)
    return written


def read_decisions(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """What reviewers have entered in a report's sections: (ordinal, match_key, status, status_note), in the sections' order."""
    parts = []
    for place, name in enumerate(DECIDED):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            rows = spark.read.format(format).option("header", True).load(f"{path}/{name}")
            parts.append(decisions_of(rows).withColumn("ordinal", F.struct(F.lit(place).alias("place"), F.monotonically_increasing_id().alias("row"))))
    if not parts:
        return spark.createDataFrame([], "match_key string, status string, status_note string, ordinal struct<place:int,row:bigint>")
    return reduce(DataFrame.unionByName, parts)


def run_summary(live: DataFrame, items: DataFrame, candidates: DataFrame, matches: DataFrame, queue: DataFrame, exceptions: DataFrame, unseen: DataFrame, overflow: DataFrame, **labels) -> DataFrame:
    """One row of counts and labels. Their names."""
    bands = lambda prefix: [F.count_if(F.col("decision_band") == b).alias(f"{prefix}_{n}") for b, n in (("auto_accept", "auto_accept"), ("review", "review"), ("possible_match", "possible_matches"))]
    current = [F.count_if(F.col("decision_band") == b).alias(f"current_run_{n}_matches") for b, n in (("auto_accept", "auto_accept"), ("review", "review"), ("possible_match", "possible"))]
    count = lambda frame, name: frame.agg(F.count("*").alias(name))
    parts = [
        count(live, "live_rows_in_quarter"),
        items.agg(F.count("*").alias("collapsed_review_items"), F.coalesce(F.sum(F.col("duplicate_count") - 1), F.lit(0)).alias("duplicates_collapsed")),
        count(candidates, "crm_candidates"),
        matches.agg(*current),
        queue.agg(*bands("current_queue")),
        count(overflow, "current_queue_review_overflow"),
        count(exceptions, "exceptions"),
        count(unseen, "not_surfaced"),
    ]
    out = parts[0]
    for p in parts[1:]:  # single rows
        out = out.join(F.broadcast(p), F.lit(True))
    return out.withColumns({k: F.lit(v) for k, v in labels.items()}) if labels else out


def as_metrics(summary: DataFrame) -> DataFrame:
    """A summary as rows (metric, value)."""
    return summary.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in summary.columns])))


def save_state(path: str, state: dict) -> None:
    Path(path).write_text(json.dumps(state, indent=2, sort_keys=True))


def load_state(path: str) -> dict:
    """The last run's state; {} if there is none or it can't be read."""
    try:
        return json.loads(Path(path).read_text())
    except (OSError, ValueError):
        return {}


def queue_notice(path: str, title: str, text: str) -> None:
    """Keeps a notice for the next time someone looks."""
    Path(path).write_text(json.dumps({"title": title, "text": text}))


def take_notice(path: str, show) -> bool:
    """Shows the kept notice; it goes once shown, or if it can't be read."""
    place = Path(path)
    if not place.exists():
        return False
    try:
        notice = json.loads(place.read_text())
        shown = bool(show(notice["title"], notice["text"]))
    except (ValueError, KeyError):
        place.unlink()
        return False
    if shown:
        place.unlink()
    return shown
