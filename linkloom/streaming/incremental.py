"""The history kept up by a stream of matches: each micro-batch is one upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkloom.operators.history import empty_history, loaded, saved, upserted


def follow(matches: DataFrame, history_path: str, checkpoint: str, run_label: str, quarter: str) -> StreamingQuery:
    """Upserts each micro-batch of a streaming frame into the history at `history_path`, which starts empty.

    Of a batch's rows with one key that with the highest score counts, and of those the first by its values as JSON. A batch that is run
    again after a failure only counts once: its number is part of the run's label, and rows that the label has
    already touched are left out.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark, label = batch.sparkSession, f"{run_label}#{number}"
        before = loaded(spark, history_path)
        history = empty_history(spark) if before is None else before
        done = history.where(F.col("last_run_label") == label).select("match_key")
        score = [F.col("match_score").desc_nulls_last()] if "match_score" in batch.columns else []
        first = Window.partitionBy("match_key").orderBy(*score, F.to_json(F.struct("*")))
        fresh = batch.join(done, "match_key", "left_anti").withColumn("__nth", F.row_number().over(first)).where("__nth = 1").drop("__nth")
        saved(upserted(history, fresh, F.current_timestamp(), label, quarter), history_path)

    return matches.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
