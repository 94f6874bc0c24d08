"""Queries of the corpus operators and their SQL, by name."""

from __future__ import annotations

from functools import partial
from importlib import import_module

#: query -> (module of this subpackage, function, name of its SQL there or None)
OPERATORS = {
    "op1_quality_rules": ("rules", "op1_quality_rules", "OP1_SQL"),
    "op2_decontaminate": ("decontaminate", "op2_decontaminate", "OP2_SQL"),
    "op3_language": ("language", "op3_language", None),
    "op4_secrets": ("secrets", "op4_secrets", None),
    "op5_toxicity": ("toxicity", "op5_toxicity", None),
    "op6_bpe": ("bpe", "op6_bpe", None),
    "op7_quality": ("quality", "op7_quality", None),
    "op8_simhash": ("near_dups", "op8_simhash", None),
    "op9_substrings": ("substrings", "op9_substrings", "OP9_SQL"),
    "op10_warc": ("warc", "op10_warc", "OP10_SQL"),
}


def _module(name: str):
    return import_module(f"linkloom.llm.{name}")


def _run(module: str, function: str, spark, sf_dir: str):
    return getattr(_module(module), function)(spark, sf_dir)


def queries() -> dict:
    """One query for each operator, and the pipeline."""
    import corpus_pipeline

    return {q: partial(_run, m, f) for q, (m, f, _) in OPERATORS.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {q: getattr(_module(m), s) for q, (m, _, s) in OPERATORS.items() if s}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
