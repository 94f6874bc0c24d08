"""Measures a history against labelled truth: `python -m linkloom.plans.score --truth T.csv --history H`."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from linkloom.operators import evaluate, history
from linkloom.sources.tables import read_truth


def labelled(truth: DataFrame, known: DataFrame, overlay: DataFrame | None = None) -> DataFrame:
    """Outcomes of the history's best predictions; truth with a key twice is an error."""
    evaluate.require_unique(truth)
    return evaluate.outcomes(truth, evaluate.predictions_of(known), overlay)


def save(path: str | None, text: str) -> None:
    if path:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(text, encoding="utf-8")


def main(args: list[str] | None = None) -> int:
    cli = argparse.ArgumentParser(description="Measure decisions against labelled truth.")
    cli.add_argument("--truth", required=True)
    cli.add_argument("--history", required=True)
    cli.add_argument("--label", default="Deterministic baseline")
    cli.add_argument("--json-out")
    cli.add_argument("--md-out")
    o = cli.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    known = history.loaded(spark, o.history)
    if known is None:
        print(f"There is no history at {o.history}.")
        return 1
    out = labelled(read_truth(spark, o.truth), known).cache()
    text = evaluate.rendered(out, o.label)
    print(text)
    save(o.md_out, text)
    save(o.json_out, json.dumps({"label": o.label, **evaluate.payload(out)}, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
