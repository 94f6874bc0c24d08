"""A run over one quarter or several: load, reject, collapse, link, annotate, keep the history, report."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from datetime import date, datetime, timezone
from functools import partial
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.config import Settings, load_settings
from linkloom.functions.dates import Quarter, latest_due_quarter, previous_quarter, quarter_from_label
from linkloom.operators import history as h
from linkloom.operators import ingest, match, report
from linkloom.operators.collapse import collapsed, duplicates, prepared
from linkloom.sources import tables

ITEM = ["source_code", "state", "dedupe_name_key"]
_kept = partial(DataFrame.persist, storageLevel=StorageLevel.MEMORY_AND_DISK)


def described_files(spark: SparkSession, files: list[tables.ExportFile]) -> DataFrame:
    """(source_file, missing): the columns that each file lacks, joined; blank if none."""
    rows = [(f.source_file, ", ".join(tables.missing_columns(list(f.header)))) for f in files]
    return spark.createDataFrame(rows, "source_file string, missing string")


def loaded(exports: DataFrame, settings: Settings, q: Quarter, files: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of the quarter with their source, exceptions) of raw exports; files: see described_files.

    A file without a source, or without one of the columns asked for, is an exception; the others are read.
    """
    spark = exports.sparkSession
    if files is None:
        lacking = ", ".join(tables.missing_columns(exports.columns))
        files = exports.select("source_file").distinct().withColumn("missing", F.lit(lacking))
    places = [(i, s.code, m) for i, s in enumerate(settings.sources) for m in s.markers]
    mappings = spark.createDataFrame(places, "place int, source_code string, marker string")
    mapped = files.join(tables.mapped_sources(files.select("source_file"), mappings), "source_file", "left")
    names = spark.createDataFrame([(s.code, s.name) for s in settings.sources], "source_code string, source_name string")
    unmapped, lacking = ingest.file_exceptions(mapped)
    wrong_files = ingest.all_exceptions(unmapped, lacking)
    fine = mapped.where("source_code is not null and missing = ''").select("source_file", "source_code")
    if tables.missing_columns(exports.columns):  # no file has them all
        return spark.createDataFrame([], "source_file string"), wrong_files
    rows = tables.live_rows(exports).join(fine, "source_file").join(F.broadcast(names), "source_code")
    good, wrong = ingest.split_rejects(ingest.in_quarter(rows, q))
    return good, ingest.all_exceptions(wrong_files, wrong)


def link_quarter(rows: DataFrame, candidates: DataFrame, settings: Settings, keep=lambda best: best) -> dict[str, DataFrame]:
    """items, matches, not_surfaced and identifier exceptions of a quarter's rows; keep: see match.linked."""
    items = collapsed(prepared(rows))
    named, identifiers = ingest.identifier_rejects(items)
    matches, unseen = match.linked(named, candidates, ITEM, settings.thresholds, keep)
    return {"items": items, "matches": h.stored(matches), "not_surfaced": unseen, "identifiers": identifiers, "duplicates": duplicates(items)}


def with_candidates(frame: DataFrame) -> DataFrame:
    """Candidates ready to link, in the order of their ids."""
    return match.prepared_candidates(tables.coerced_candidates(frame)).withColumn("ordinal", F.col("application_id"))


def run_quarter(
    spark: SparkSession, exports: DataFrame, candidates: DataFrame, settings: Settings, q: Quarter, run_label: str, seen_at: datetime | None = None,
    files: DataFrame | None = None, imported: int = 0, log_path: str = "",
) -> dict[str, DataFrame]:
    """Links a quarter, brings the history up to date and writes the report; returns the report's sections.

    The best pairs are persisted, so that names are scored once, until the report is written.
    """
    began = datetime.now(timezone.utc).replace(tzinfo=None)
    seen, held = F.lit(seen_at or began).cast("timestamp"), []

    def keep(best: DataFrame) -> DataFrame:
        held.append(_kept(best))
        return held[-1]

    rows, wrong = loaded(exports, settings, q, files)
    empty = "live_business_name" not in rows.columns
    parts = None if empty else link_quarter(rows, candidates, settings, keep)
    before = h.loaded(spark, settings.history_path)
    known = h.empty_history(spark) if before is None else h.with_missing_columns(before, h.COLUMNS)
    matches = parts["matches"] if parts else h.empty_history(spark)
    annotated = h.annotated(matches, known)
    h.saved(h.upserted(known, matches, seen, run_label, q.label), settings.history_path)
    queue = h.queue(h.loaded(spark, settings.history_path))
    shown, over = match.with_review_cap(queue, settings.thresholds.max_review_rows)
    if parts:
        exceptions = ingest.all_exceptions(wrong, parts["identifiers"].select("exception_type", "live_business_name", F.col("source_row_numbers").alias("detail")))
    else:
        exceptions, parts = wrong, {"items": spark.createDataFrame([], "duplicate_count bigint"), "duplicates": rows, "not_surfaced": rows}
    labels = {"quarter": q.label, "quarter_start": q.start.isoformat(), "quarter_end": q.end.isoformat(), "imported_status_updates": imported, "run_label": run_label, "log_path": log_path}
    sections = {
        "summary": report.run_summary(rows, parts["items"], candidates, annotated, shown, exceptions, parts["not_surfaced"], over, **labels),
        "auto_accept": shown.where("decision_band = 'auto_accept'"),
        "review": shown.where("decision_band = 'review'"),
        "possible_matches": shown.where("decision_band = 'possible_match'"),
        "exceptions": exceptions,
        "duplicates": parts["duplicates"],
        "review_overflow": over,
        "not_surfaced": parts["not_surfaced"],
    }
    row = sections["summary"].first()
    counted = spark.createDataFrame([row], sections["summary"].schema)
    if settings.report_enabled:
        flat = {k: _flat(v) for k, v in sections.items()} if settings.report_format == "csv" else sections
        report.write_report(report.report_path(settings.output_path), {**flat, "summary": report.as_metrics(counted)}, settings.report_format)
    for frame in held:
        frame.unpersist()
    return {**sections, "summary": counted}


def _flat(frame: DataFrame) -> DataFrame:
    """Arrays as text, for formats without them."""
    return frame.withColumns({f.name: F.to_json(f.name) for f in frame.schema if f.dataType.typeName() in ("array", "struct", "map")})


def import_decisions(spark: SparkSession, settings: Settings) -> int:
    """Takes reviewers' decisions from the current report into the history; how many matches they change."""
    known = h.loaded(spark, settings.history_path)
    if known is None:
        return 0
    said = report.read_decisions(spark, report.report_path(settings.output_path), settings.report_format)
    changes = h.decision_changes(known, said)
    if changes:
        h.saved(h.with_decisions(known, said, F.current_timestamp()), settings.history_path)
    return changes


def opened_log(folder: str) -> tuple[logging.Logger, str]:
    """A logger to the console and to a file below `folder`, which a later run replaces."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    path = str(Path(folder) / "matcher_run_current.log")
    log = logging.getLogger("linkloom.run")
    log.setLevel(logging.INFO)
    log.handlers.clear()
    for handler in (logging.FileHandler(path, encoding="utf-8"), logging.StreamHandler(sys.stdout)):
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(handler)
    return log, path


def _show(title: str, text: str) -> bool:
    print(f"{title}: {text}")
    return True


def main(args: list[str] | None = None) -> int:
    cli = argparse.ArgumentParser(description="Link partner exports with candidates.")
    cli.add_argument("--config", required=True)
    cli.add_argument("--quarter", help="such as 2026Q2; the last calendar quarter without it")
    cli.add_argument("--work-dir", default=".", help="folder of the log, the run's state, notices and backups")
    cli.add_argument("--backfill-history", action="store_true", help="all quarters up to the target")
    cli.add_argument("--rebuild-history", action="store_true", help="start from an empty history; the old one is backed up")
    cli.add_argument("--ensure-due-quarter-run", action="store_true", help="run the due quarter, or nothing if it has run")
    cli.add_argument("--disable-notifications", action="store_true")
    cli.add_argument("--queue-logon-notification", action="store_true", help="keep a notice for later")
    cli.add_argument("--show-pending-notification-only", action="store_true", help="show a kept notice and stop")
    cli.add_argument("--deliver-pending-notification", action="store_true", help="show a kept notice at the end")
    o = cli.parse_args(args)
    settings, work = load_settings(o.config), Path(o.work_dir) / "logs"
    notice, state_path = str(work / "pending_notification.json"), str(work / "run_state.json")
    if o.show_pending_notification_only:
        report.take_notice(notice, _show)
        return 0
    log, log_path = opened_log(str(work))
    state, today = report.load_state(state_path), date.today()
    target = quarter_from_label(o.quarter) if o.quarter else previous_quarter(today)
    if o.ensure_due_quarter_run:
        due = latest_due_quarter(today)
        if state.get("last_completed_quarter") == due.label:
            if o.deliver_pending_notification:
                report.take_notice(notice, _show)
            return 0
        target = due
    spark = SparkSession.builder.getOrCreate()
    imported = 0
    if o.rebuild_history:
        backup = h.backed_up(spark, settings.history_path, f"{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}")
        h.saved(h.empty_history(spark), settings.history_path)
        log.info("Started an empty history; the old one is at %s", backup)
    else:
        imported = import_decisions(spark, settings)
        log.info("Imported %s status updates from the current report", imported)
    found = tables.export_files(spark, settings.live_path)
    files, exports = described_files(spark, found), tables.read_exports(spark, found)
    quarters = [target]
    if o.backfill_history:
        usable = loaded_dates(exports, settings)
        quarters = [quarter_from_label(r.quarter) for r in tables.discovered_quarters(usable, target.label).collect()]  # a label for each quarter
    if not quarters:
        log.warning("No quarters were found up to %s", target.label)
        return 0
    source = tables.read_candidates(spark, settings.candidates_csv) if settings.candidates_csv else database_candidates(spark, settings)
    candidates = _kept(with_candidates(source))
    log.info("Quarters: %s", ", ".join(q.label for q in quarters))
    base = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}"
    for i, q in enumerate(quarters):
        label = f"{base}_{q.label}"
        sections = run_quarter(spark, exports, candidates, settings, q, label, files=files, imported=imported if i == 0 else 0, log_path=log_path)
        summary = sections["summary"].first().asDict()
        log.info("%s", json.dumps(summary, default=str))
        at = report.report_path(settings.output_path)
        done = {"last_completed_quarter": q.label, "last_completed_run_label": label, "last_completed_at": datetime.now(timezone.utc).isoformat(), "workbook_path": at}
        report.save_state(state_path, done)
    waiting = sum(summary[f"current_queue_{b}"] for b in ("auto_accept", "review", "possible_matches"))
    text = f"{quarters[-1].label}: {waiting} unresolved matches are waiting" + (f" in {at}" if settings.report_enabled else "")
    if o.queue_logon_notification:
        report.queue_notice(notice, "Match review is ready", text)
    if settings.notifications and not o.disable_notifications:
        _show("Match review is ready", text)
    if o.deliver_pending_notification:
        report.take_notice(notice, _show)
    return 0


def loaded_dates(exports: DataFrame, settings: Settings) -> DataFrame:
    """origination_date of the rows of files that have a source and that column."""
    if "Origination Date" not in exports.columns:
        return exports.sparkSession.createDataFrame([], "origination_date date")
    markers = [F.contains(F.lower("source_file"), F.lit(m.lower())) for s in settings.sources for m in s.markers]
    known = F.lit(False)
    for m in markers:
        known = known | m
    return exports.where(known).select(F.to_date(F.try_to_timestamp(F.col("`Origination Date`").cast("string"))).alias("origination_date"))


def database_candidates(spark: SparkSession, settings: Settings) -> DataFrame:
    d = settings.database
    return tables.extract_candidates(**tables.database_tables(spark, d.url, d.schema, **d.options()))


if __name__ == "__main__":
    raise SystemExit(main())
