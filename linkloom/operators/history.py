"""The match history: annotate, upsert, decisions and the open queue.

The history has one row for each match key. Every change makes a new snapshot from a join, which is written to a
folder of its own; readers take the last complete one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import stable_hash

# States of a match.
STATUSES = ["new", "confirmed", "rejected", "billed"]
# What the queue is ordered by.
BAND_RANK = {"auto_accept": 0, "review": 1, "possible_match": 2}
STATUS_RANK = {"Approved": 0, "SentForEducation": 1, "InProgress": 2, "Unassigned": 3, "Denied": 4, "Discarded": 5, "Archived": 6}
# The stored columns and their types.
COLUMNS = {
    "match_key": "string", "live_record_key": "string", "candidate_application_id": "bigint", "candidate_business_id": "bigint", "candidate_customer_id": "bigint",
    "decision_band": "string", "status": "string", "status_note": "string", "match_score": "double", "name_score": "double", "score_gap": "double",
    "billed_quarter": "string", "billed_amount": "double", "invoice_date": "date", "first_seen_at": "timestamp", "last_seen_at": "timestamp", "status_updated_at": "timestamp",
    "quarter_first_seen": "string", "first_run_label": "string", "last_run_label": "string", "times_seen": "bigint", "source_code": "string", "source_name": "string",
    "state": "string", "live_business_name": "string", "crm_source_code": "string", "crm_source_name": "string", "crm_business_name": "string", "origination_dates": "string",
    "primary_origination_date": "date", "origination_amounts": "string", "primary_origination_amount": "double", "source_files": "string", "source_sheets": "string",
    "source_row_numbers": "string", "duplicate_count": "bigint", "candidate_status": "string", "candidate_loan_range": "string", "candidate_business_state": "string",
    "candidate_business_zip": "string", "application_created_date": "date", "prescreen_created_date": "date", "lead_start_date": "date", "matched_live_variant": "string",
    "matched_candidate_variant": "string", "supporting_signals": "string", "alternative_candidate_name": "string", "alternative_candidate_score": "double",
}
#: What the columns of matches that come from candidates are called in the history.
STORED_AS = {
    "application_id": "candidate_application_id", "business_id": "candidate_business_id", "customer_id": "candidate_customer_id", "application_status": "candidate_status",
    "loan_range": "candidate_loan_range", "business_zip_code": "candidate_business_zip", "candidate_source_name": "crm_source_name",
}
#: Columns that an upsert leaves as they are for a known match.
KEPT = ["first_seen_at", "quarter_first_seen", "first_run_label", "status", "status_note", "status_updated_at", "billed_quarter", "billed_amount", "invoice_date"]


def match_key(record_key: Column, application_id: Column) -> Column:
    return stable_hash(record_key, application_id.cast("bigint"))


def empty_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{k} {v}" for k, v in COLUMNS.items()))


def stored(matches: DataFrame) -> DataFrame:
    """Linked matches with their key and the history's column names; the block is the candidate's source and state too."""
    named = matches.withColumn("match_key", match_key(F.col("live_record_key"), F.col("application_id"))).withColumnsRenamed(STORED_AS)
    return named.withColumns({"crm_source_code": F.col("source_code"), "candidate_business_state": F.col("state")})


def normal_status(c: Column) -> Column:
    low = F.lower(F.trim(F.coalesce(c.cast("string"), F.lit(""))))
    return F.when(low.isin(STATUSES), low).otherwise(F.lit("new"))


def clean_note(c: Column) -> Column:
    note = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(F.lower(note) == "nan", F.lit("")).otherwise(note)


def annotated(matches: DataFrame, history: DataFrame) -> DataFrame:
    """`matches` with what the history knows of them."""
    known = history.select("match_key", "first_seen_at", "last_seen_at", "times_seen", "status", "status_note", F.lit(True).alias("__known"))
    out = matches.join(known, "match_key", "left")
    blank = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("first_seen_at", "last_seen_at", "status_note")}
    rest = {"times_seen": F.coalesce("times_seen", F.lit(0)), "status": F.coalesce("status", F.lit("new")), "is_new_match": F.col("__known").isNull()}
    return out.withColumns(blank | rest).drop("__known")


def upserted(history: DataFrame, matches: DataFrame, seen_at: Column, run_label: str, quarter: str) -> DataFrame:
    """The next snapshot: new matches are added, known ones refreshed, all others stay."""
    old = history.select("*", F.lit(True).alias("__old")).alias("o")
    new = matches.select("*", F.lit(True).alias("__new")).alias("n")
    both = old.join(new, F.col("o.match_key") == F.col("n.match_key"), "full_outer")
    seen, known = F.col("n.__new").isNotNull(), F.col("o.__old").isNotNull()
    first = {"first_seen_at": seen_at, "quarter_first_seen": F.lit(quarter), "first_run_label": F.lit(run_label), "status": F.lit("new"), "status_note": F.lit("")}
    columns = []
    for c in history.columns:
        kind = history.schema[c].dataType
        before = F.col(f"o.{c}")
        if c == "match_key":
            value = F.coalesce(F.col("n.match_key"), F.col("o.match_key"))
        elif c == "times_seen":
            value = F.when(seen, F.coalesce(before, F.lit(0)) + 1).otherwise(before)
        elif c == "last_seen_at":
            value = F.when(seen, seen_at).otherwise(before)
        elif c == "last_run_label":
            value = F.when(seen, F.lit(run_label)).otherwise(before)
        elif c in KEPT:
            value = F.when(known, before).otherwise(first.get(c, F.lit(None)))
        else:
            value = F.when(seen, F.col(f"n.{c}")).otherwise(before) if c in matches.columns else before
        columns.append(value.cast(kind).alias(c))
    return both.select(*columns)


def last_decisions(decisions: DataFrame) -> DataFrame:
    usable = decisions.withColumn("status", normal_status(F.col("status"))).where("status <> 'new'")
    return usable.groupBy(F.trim("match_key").alias("match_key")).agg(F.max_by("status", "ordinal").alias("__status"), F.max_by(clean_note(F.col("status_note")), F.col("ordinal")).alias("__note"))


def _changes() -> Column:
    return F.col("__status").isNotNull() & (F.col("__status") != F.col("status"))


def decision_changes(history: DataFrame, decisions: DataFrame) -> int:
    """How many matches `with_decisions` changes."""
    return history.join(last_decisions(decisions), "match_key").where(_changes()).count()


def with_decisions(history: DataFrame, decisions: DataFrame, at: Column) -> DataFrame:
    """The next snapshot with reviewers' decisions (ordinal, match_key, status, status_note); `new` is no decision.

    Of several decisions on a match the last counts. A decision equal to the known status changes nothing.
    """
    both = history.join(last_decisions(decisions), "match_key", "left")
    change = _changes()
    changed = {
        "status_note": F.when(change, F.col("__note")).otherwise(F.col("status_note")),
        "status_updated_at": F.when(change, at).otherwise(F.col("status_updated_at")),
        "status": F.when(change, F.col("__status")).otherwise(F.col("status")),
    }
    return both.withColumns(changed).select(*history.columns)


def _rank(c: Column, ranks: dict[str, int]) -> Column:
    known = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])
    return F.coalesce(F.try_element_at(known, c), F.lit(9))


def queue(history: DataFrame) -> DataFrame:
    """Open matches of all quarters in the order of review."""
    ranked = history.where("status = 'new'").withColumn("band_rank", _rank(F.col("decision_band"), BAND_RANK)).withColumn("status_rank", _rank(F.col("candidate_status"), STATUS_RANK))
    return ranked.orderBy("band_rank", "status_rank", F.col("match_score").desc(), F.col("first_seen_at"))


def with_missing_columns(history: DataFrame, columns: dict[str, str]) -> DataFrame:
    """`history` with columns that later versions added, null where they were missing."""
    return history.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items() if c not in history.columns})


def from_legacy(rows: DataFrame, columns: list[str], payload: str = "payload_json") -> DataFrame:
    """Rows of the older shape: values of the JSON payload count first, then the row's own columns."""
    values = {c: F.coalesce(F.get_json_object(payload, f"$.{c}"), F.col(c).cast("string") if c in rows.columns else F.lit(None)) for c in columns}
    out = rows.select(*[v.alias(c) for c, v in values.items()])
    return out.withColumns({"status": normal_status(F.col("status")), "times_seen": F.coalesce(F.col("times_seen").try_cast("bigint"), F.lit(1)), "match_score": F.col("match_score").try_cast("double")})


def _snapshots(spark, path: str):
    """(filesystem, folder, names of complete snapshots in order)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [x.getPath() for x in files.listStatus(at)] if files.exists(at) else []
    done = [p.getName() for p in there if p.getName().startswith("snapshot-") and files.exists(p.suffix("/_SUCCESS"))]
    return files, at, sorted(done)


def saved(history: DataFrame, path: str) -> None:
    """Writes the next snapshot below `path`; the one before stays, as frames may still read it, and older ones go."""
    files, at, done = _snapshots(history.sparkSession, path)
    number = int(done[-1].rpartition("-")[2]) + 1 if done else 0
    history.write.mode("overwrite").parquet(f"{path}/snapshot-{number:08d}")
    for name in done[:-1]:
        files.delete(at.suffix(f"/{name}"), True)


def loaded(spark, path: str) -> DataFrame | None:
    """The last snapshot, or None before the first."""
    _, _, done = _snapshots(spark, path)
    return spark.read.parquet(f"{path}/{done[-1]}") if done else None


def backed_up(spark, path: str, label: str) -> str | None:
    """Copies the last snapshot beside the history; None if there is none."""
    last = loaded(spark, path)
    if last is None:
        return None
    last.write.parquet(f"{path}-backup-{label}")
    return f"{path}-backup-{label}"
