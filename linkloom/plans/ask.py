"""Asks a model about the deferred matches of a history and measures what that changes.

`python -m linkloom.plans.ask --truth T.csv --history H --candidates C.csv --stub`, or with `--url`, `--model`
and `--key-variable` for a hosted model.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import name_variants
from linkloom.operators import adjudicate, evaluate, history
from linkloom.plans.run import with_candidates
from linkloom.plans.score import labelled, save
from linkloom.sources.tables import read_candidates, read_truth

KEY = evaluate.KEY


def decisions(known: DataFrame, candidates: DataFrame, model: adjudicate.Model, most: int | None) -> DataFrame:
    """A decision for each deferred match of the history, up to the cap."""
    due = adjudicate.deferred(known).select(*KEY, "source_name", "decision_band", "primary_origination_amount", "primary_origination_date").dropDuplicates(KEY)
    items = due.withColumn("live_name_variants", name_variants(F.col("live_business_name")))
    requests = adjudicate.requests_of(items, adjudicate.offers(items, candidates, KEY), KEY)
    return adjudicate.decided(adjudicate.asked(requests, model, KEY, most))


def main(args: list[str] | None = None) -> int:
    cli = argparse.ArgumentParser(description="Ask a model about deferred matches.")
    cli.add_argument("--truth", required=True)
    cli.add_argument("--history", required=True)
    cli.add_argument("--candidates", required=True)
    cli.add_argument("--stub", action="store_true", help="no network: every request is declined")
    cli.add_argument("--url")
    cli.add_argument("--model")
    cli.add_argument("--key-variable", help="environment variable that holds the key")
    cli.add_argument("--max-rows", type=int, default=100)
    cli.add_argument("--out")
    cli.add_argument("--md-out")
    o = cli.parse_args(args)
    if not o.stub and not (o.url and o.model and o.key_variable):
        cli.error("--url, --model and --key-variable are needed without --stub")
    spark = SparkSession.builder.getOrCreate()
    known = history.loaded(spark, o.history)
    if known is None:
        print(f"There is no history at {o.history}.")
        return 1
    model = adjudicate.Stub() if o.stub else adjudicate.HostedModel(adjudicate.https_sender(o.url, o.key_variable), o.model)
    said = decisions(known, with_candidates(read_candidates(spark, o.candidates)), model, o.max_rows).cache()
    used, truth = adjudicate.totals(said).first().asDict(), read_truth(spark, o.truth)
    plain, helped = labelled(truth, known), labelled(truth, known, adjudicate.overlay(said, KEY))
    asked = max(used["requests"], 1)
    cost = [
        f"- requests: **{used['requests']}** (resolved {used['resolved']}, declined {used['refused']}, errors {used['errors']})",
        f"- tokens: {used['input_tokens'] or 0:,} in, {used['output_tokens'] or 0:,} out",
        f"- latency: {(used['latency_ms'] or 0) / asked:,.0f} ms on average",
    ]
    text = "\n".join([evaluate.rendered(plain, "Deterministic baseline"), evaluate.rendered(helped, "With adjudication"), "## Cost and latency", "", *cost, ""])
    print(text)
    save(o.md_out, text)
    rows = said.select(*KEY, "offered", "resolved", F.col("chosen").alias("application_id"), "confidence", "reasoning", "refused_reason", F.coalesce(F.nullif("call_error", F.lit("")), "error").alias("error"), "latency_ms")
    save(o.out, json.dumps({"baseline": evaluate.payload(plain), "adjudicated": evaluate.payload(helped), "usage": used, "decisions": [r.asDict() for r in rows.collect()]}, indent=2, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
