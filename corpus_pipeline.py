"""The corpus pipeline: toxicity, near-duplicates, benchmark decontamination, secrets, BPE.

Each stage is a function of (spark, docs, sf_dir) that gives a DataFrame; it works on all rows that the stage
before it kept. All but the last return the columns of `docs`. The tables `labels` and `benchmark` are read
from sf_dir. Null texts are kept as they are by the filters (they have no words and the score of an empty text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import bpe, decontaminate, near_dups, secrets, toxicity
from linkloom.llm.common import dropped, spare_names, table, written


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is under 0.5; the machine is learned from the labelled ones among them."""
    score = spare_names(docs.columns, "toxicity")[0]
    scored = toxicity.with_toxicity(docs, toxicity.learned_from(spark, docs, sf_dir), out=score)
    return scored.where(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return near_dups.one_of_each(docs)


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the text; n_chars counts the new text."""
    kept = secrets.redacted(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def encode(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of tokens, the ids, and digests of the ids and of the text that they decode to."""
    coded = bpe.with_ids_and_digests(docs, bpe.default_vocabulary())
    return coded.select("doc_id", "bpe.n_tokens", "bpe.ids", "bpe.ids_sha256", "bpe.decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", encode),
]


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read by the next."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if before:
            dropped(spark, before)
        before = path
    return docs


#: The stages score with a learned model and encode with a vocabulary, which SQL can't express.
ORACLE_SQL = None
