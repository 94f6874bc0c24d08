"""Decisions against labelled truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.text import rounded

KEY = ["source_code", "live_business_name", "state"]
# Outcomes of a truth row.
LABELS = ["resolved_correct", "resolved_wrong", "false_resolution", "deferred_correct", "deferred_wrong", "deferred_trap", "missed", "correctly_abstained"]
DEFERRED = ["review", "possible_match"]


def repeated_keys(truth: DataFrame, key: list[str] = KEY) -> DataFrame:
    return truth.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def require_unique(truth: DataFrame, key: list[str] = KEY) -> None:
    wrong = repeated_keys(truth, key).limit(20).collect()
    if wrong:
        raise ValueError(f"truth has keys with several rows: {wrong}")


def best_predictions(history: DataFrame, key: list[str] = KEY, order: str = "ordinal") -> DataFrame:
    """The prediction with the highest score of each key; the first of equal ones."""
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.coalesce("match_score", F.lit(0.0)).desc(), order))
    return history.withColumn("__nth", nth).where("__nth = 1").drop("__nth")


def outcome(expected: Column, predicted: Column, band: Column) -> Column:
    """Label of a truth row: expected is null where no match is right."""
    trap, auto, right = expected.isNull(), band == "auto_accept", F.coalesce(expected == predicted, F.lit(False))
    on_trap = F.when(band.isNull(), "correctly_abstained").when(auto, "false_resolution").otherwise("deferred_trap")
    resolved = F.when(right, "resolved_correct").otherwise("resolved_wrong")
    deferred = F.when(right, "deferred_correct").otherwise("deferred_wrong")
    return F.when(trap, on_trap).when(band.isNull(), "missed").when(auto, resolved).otherwise(deferred)


def outcomes(truth: DataFrame, predictions: DataFrame, overlay: DataFrame | None = None, key: list[str] = KEY) -> DataFrame:
    """`truth` with predicted, band and label; the overlay (key, application_id) resolves deferred rows."""
    both = truth.join(predictions.select(*key, F.col("application_id").alias("predicted"), F.col("decision_band").alias("band")), key, "left")
    if overlay is not None:
        both = both.join(overlay.select(*key, F.col("application_id").alias("__chosen")), key, "left")
        apply = F.col("__chosen").isNotNull() & F.col("band").isin(DEFERRED)
        both = both.withColumn("predicted", F.when(apply, F.col("__chosen")).otherwise(F.col("predicted"))).withColumn("band", F.when(apply, F.lit("auto_accept")).otherwise(F.col("band"))).drop("__chosen")
    return both.withColumn("label", outcome(F.col("expected"), F.col("predicted"), F.col("band")))


def percent(part: Column, whole: Column) -> Column:
    """One decimal; 0 of nothing is 0."""
    return F.when(whole == 0, 0.0).otherwise(rounded(part.cast("double") * 100 / F.nullif(whole, F.lit(0)), 1))


def metrics(labelled: DataFrame) -> DataFrame:
    """One row: counts by label and the ratios made of them."""
    counts = labelled.agg(F.count("*").alias("records"), F.count_if(F.col("expected").isNotNull()).alias("expecting_a_match"), F.count_if(F.col("expected").isNull()).alias("traps"), *[F.count_if(F.col("label") == x).alias(x) for x in LABELS])
    made = F.col("resolved_correct") + F.col("resolved_wrong") + F.col("false_resolution")
    left = F.col("deferred_correct") + F.col("deferred_wrong") + F.col("deferred_trap")
    return counts.withColumns({"automated": made, "human_queue": left}).withColumns(
        {
            "automation_precision": percent(F.col("resolved_correct"), F.col("automated")),
            "automation_rate": percent(F.col("resolved_correct"), F.col("records") - F.col("traps")),
            "error_rate": percent(F.col("resolved_wrong") + F.col("false_resolution"), F.greatest(F.col("automated"), F.lit(1))),
            "trap_survival": percent(F.col("deferred_trap") + F.col("correctly_abstained"), F.greatest(F.col("traps"), F.lit(1))),
        }
    )


def by_case(labelled: DataFrame, case: str = "case") -> DataFrame:
    return labelled.groupBy(case).pivot("label", LABELS).count().na.fill(0).orderBy(case)


def predictions_of(history: DataFrame) -> DataFrame:
    """A history's best prediction for each key, as `outcomes` takes it; of equal scores that with the least match_key."""
    best = best_predictions(history.where("live_business_name is not null"), KEY, "match_key")
    return best.select(*KEY, F.col("candidate_application_id").alias("application_id"), "decision_band", "match_score", "score_gap")


def markdown(table: DataFrame) -> str:
    """A report's table; for results of a few rows."""
    rows, head = [[str(v) for v in r] for r in table.collect()], table.columns
    widths = [max(len(x[i]) for x in [head, *rows]) for i in range(len(head))]
    line = lambda cells: "| " + " | ".join(c.ljust(w) for c, w in zip(cells, widths, strict=True)) + " |"
    return "\n".join([line(head), "|" + "|".join("-" * (w + 2) for w in widths) + "|", *map(line, rows)])


def counts_of(labelled: DataFrame) -> DataFrame:
    """(outcome, n), the commonest first."""
    return labelled.groupBy(F.col("label").alias("outcome")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "outcome")


def rendered(labelled: DataFrame, title: str) -> str:
    """A report of outcomes in Markdown: the metrics, the outcomes, and the outcomes of each case (those that occur)."""
    m = metrics(labelled).first()
    lines = [
        f"- records: **{m.records}**, of which {m.expecting_a_match} expect a match and {m.traps} none",
        f"- automated: **{m.automated}**, left to a person: **{m.human_queue}**",
        f"- automation precision: **{m.automation_precision}%** of the automated decisions are right",
        f"- automation rate: **{m.automation_rate}%** of the records that expect a match are resolved and right",
        f"- error rate: **{m.error_rate}%** of the automated decisions are wrong",
        f"- trap survival: **{m.trap_survival}%** of the records that expect none are not resolved",
    ]
    found = counts_of(labelled)
    seen = [r.outcome for r in found.collect()]
    cases = by_case(labelled).select("case", *[x for x in sorted(LABELS) if x in seen])
    return "\n".join([f"## {title}", "", *lines, "", "### Outcomes", "", markdown(found), "", "### By case", "", markdown(cases), ""])


def payload(labelled: DataFrame) -> dict:
    """Metrics and counts for JSON."""
    return {"metrics": metrics(labelled).first().asDict(), "counts": {r.outcome: r.n for r in counts_of(labelled).collect()}}
