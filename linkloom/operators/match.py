"""Blocking, scores, corroboration, bands and what is not surfaced.

Items and candidates meet in blocks of source and state by an equi-join; cheap tests come before names are
scored. Blocks are counted first, and the pairs of a large one are dealt out to as many parts as they need: pairs
are scored where the join makes them, and only those that pass are shuffled. Names are scored once for each distinct pair of variant lists in a task (a bounded memo).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.config import Thresholds
from linkloom.functions.dates import days_between
from linkloom.functions.similarity import name_match
from linkloom.functions.text import join_name, name_variants, round2, size_band

BLOCK = ["source_code", "state"]
#: Pairs that one part of a block may make.
PART_PAIRS = 250_000
# Reasons for items that are not surfaced.
NO_BLOCK = "No candidates for this source/state."
NO_SCORE = "No candidate cleared the score threshold."
BELOW = "Top candidate still fell below review threshold."


def prepared_candidates(frame: DataFrame) -> DataFrame:
    """Candidates with their state, block and variants; `ordinal` is their order in the input."""
    state = F.coalesce(F.nullif(F.trim(F.upper("business_state")), F.lit("")), F.col("prescreen_state"), F.lit(""))
    names = name_variants(
        F.col("crm_business_name"),
        join_name(F.col("customer_first_name"), F.col("customer_last_name")),
        join_name(F.col("prescreen_first_name"), F.col("prescreen_last_name")),
    )
    return frame.withColumn("candidate_state", state).withColumn("candidate_name_variants", names).withColumn("loan_band", size_band(F.col("loan_range")))


def candidate_side(candidates: DataFrame) -> DataFrame:
    """Candidates with the names that blocks go by."""
    return candidates.withColumnRenamed("candidate_source", "source_code").withColumnRenamed("candidate_state", "state")


def blocked(items: DataFrame, candidates: DataFrame, item_key: list[str]) -> DataFrame:
    """Pairs of items and candidates in the same source and state."""
    return dealt_pairs(items, candidate_side(candidates), BLOCK, item_key, deal_right_by=["application_id"])


def block_pairs(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """(key, n_left, n_right, pairs): what left JOIN right USING (on) makes of each key, by counts."""
    sizes = left.groupBy(*on).agg(F.count("*").alias("n_left")).join(right.groupBy(*on).agg(F.count("*").alias("n_right")), on)
    return sizes.withColumn("pairs", F.col("n_left") * F.col("n_right"))


def dealt_pairs(left: DataFrame, right: DataFrame, on: list[str], deal_by: list[str], part_pairs: int = PART_PAIRS, deal_right_by: list[str] | None = None) -> DataFrame:
    """left JOIN right USING (on), in tasks of about `part_pairs` pairs.

    A key's pairs are a grid of about pairs / part_pairs parts. Its rows of `left` are dealt out to the grid's rows by a
    hash of `deal_by` and those of `right` to its columns by one of `deal_right_by` (all columns if not given), and each goes to all parts of its
    row or column; the shorter side has fewer, so that the fewest copies are made. The number of tasks follows from the
    counts, as adaptive execution, which goes by bytes, would put many parts into one task.
    """
    part = "part"
    while any(c.startswith(part) for c in left.columns + right.columns):
        part += "_"
    row, column, rows, columns = (part + x for x in ("_row", "_column", "_rows", "_columns"))
    sizes = block_pairs(left, right, on)
    most = F.ceil(F.col("pairs") / F.lit(part_pairs))
    ideal = F.ceil(F.sqrt(F.col("pairs") / F.lit(part_pairs) * F.col("n_left") / F.col("n_right")))
    grid = sizes.select(*on, F.greatest(F.lit(1), F.least(ideal, most, F.col("n_left"))).cast("int").alias(rows), most.alias(part))
    grid = grid.select(*on, rows, F.ceil(F.col(part) / F.col(rows)).cast("int").alias(columns))
    all_parts, pairs = grid.join(sizes, on).agg(F.sum(F.col(rows).cast("bigint") * F.col(columns)), F.sum("pairs")).first()
    tasks = int(min(all_parts or 1, max(left.sparkSession.sparkContext.defaultParallelism, (pairs or 0) // part_pairs + 1)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = left.join(grid, on).withColumn(row, F.pmod(F.hash(*deal_by), F.col(rows))).withColumn(column, every(columns)).drop(rows, columns)
    copied = right.join(grid, on).withColumn(column, F.pmod(F.hash(*(deal_right_by or right.columns)), F.col(columns))).withColumn(row, every(rows)).drop(rows, columns)
    keys = [*on, row, column]
    return dealt.repartition(tasks, *keys).join(copied.repartition(tasks, *keys), keys).drop(row, column)


def predates_lead(origination: Column, lead: Column, grace: float) -> Column:
    return F.coalesce(days_between(origination, lead) < -grace, F.lit(False))


def corroboration(pairs: DataFrame) -> DataFrame:
    """`pairs` with adjustment and supporting_signals."""
    zips = [F.col(c) for c in ("business_zip_code", "prescreen_zip_code", "prescreen_business_zip_code") if c in pairs.columns]
    zip_hit = F.lit(False)
    for z in zips:
        zip_hit = zip_hit | F.coalesce((F.trim(z) != "") & F.contains("live_zip_codes", F.trim(z)), F.lit(False))
    banded = pairs if "loan_band" in pairs.columns else pairs.withColumn("loan_band", size_band(F.col("loan_range")))
    low, high, amount = F.col("loan_band.low"), F.col("loan_band.high"), F.col("primary_origination_amount")
    inside = F.coalesce((amount >= low) & (amount <= high), F.lit(False))
    near = ~inside & F.coalesce((amount >= 0.5 * low) & (amount <= 1.5 * high), F.lit(False))
    days = days_between(F.col("primary_origination_date"), F.col("lead_start_date"))
    points = F.when(zip_hit, 4.0).otherwise(0.0) + F.when(inside, 3.0).when(near, 1.0).otherwise(0.0)
    signals = F.concat_ws(
        "; ",
        F.lit("source matched"),
        F.lit("state matched"),
        F.when(zip_hit, "zip matched"),
        F.when(inside, "amount within loan range").when(near, "amount roughly aligned with loan range"),
        F.when(days >= 0, "origination after lead created").when(days < 0, "origination slightly before lead date"),
    )
    return banded.withColumn("adjustment", points).withColumn("supporting_signals", signals)


def scored(items: DataFrame, candidates: DataFrame, item_key: list[str], limits: Thresholds) -> DataFrame:
    """Pairs that pass the date guard, the name's floor and guard and the candidate's floor, with their scores."""
    pairs = blocked(items, candidates, item_key)
    timely = pairs.where(~predates_lead(F.col("primary_origination_date"), F.col("lead_start_date"), limits.max_days_origination_before_lead))
    named = timely.withColumn("__name", name_match(F.col("live_name_variants"), F.col("candidate_name_variants"), limits.min_name_score))
    likely = named.where((F.col("__name.name_score") >= limits.min_name_score) & F.col("__name.signal"))
    flat = likely.select("*", *[F.col(f"__name.{a}").alias(b) for a, b in (("name_score", "name_score"), ("live_variant", "matched_live_variant"), ("candidate_variant", "matched_candidate_variant"))]).drop("__name")
    overall = round2(F.least(F.lit(100.0), F.col("name_score") + F.col("adjustment")))
    return corroboration(flat).withColumn("overall_score", overall).where(F.col("overall_score") >= limits.min_candidate_score)


def band(score: Column, gap: Column, name_score: Column, limits: Thresholds) -> Column:
    sure = (score >= limits.auto_accept_score) & (name_score >= limits.auto_accept_score - 2) & (gap >= limits.min_score_gap)
    return F.when(sure, "auto_accept").when(score >= limits.review_score, "review").when(score >= limits.possible_score, "possible_match").otherwise("discard")


def best_of_each(pairs: DataFrame, item_key: list[str], limits: Thresholds) -> DataFrame:
    """The best pair of each item, with the gap to the next, the runner-up and the band; ties go to the first candidate."""
    order = Window.partitionBy(*item_key).orderBy(F.col("overall_score").desc(), F.col("ordinal"))
    ranked = (
        pairs.withColumn("__nth", F.row_number().over(order))
        .withColumn("alternative_candidate_score", F.lead("overall_score").over(order))
        .withColumn("alternative_candidate_name", F.lead("crm_business_name").over(order))
    )
    top = ranked.where("__nth = 1").drop("__nth").withColumnRenamed("overall_score", "match_score")
    gap = round2(F.col("match_score") - F.coalesce("alternative_candidate_score", F.lit(0.0)))
    return top.withColumn("score_gap", gap).withColumn("decision_band", band(F.col("match_score"), F.col("score_gap"), F.col("name_score"), limits))


def tallied(items: DataFrame, candidates: DataFrame, limits: Thresholds) -> DataFrame:
    """(block, primary_origination_date, n, late): candidates of the block, and those that the date guard excludes.

    They are counted by day first, so that days meet days rather than items candidates.
    """
    day = "primary_origination_date"
    days = items.select(*BLOCK, day).distinct()
    leads = candidate_side(candidates).groupBy(*BLOCK, "lead_start_date").agg(F.count("*").alias("m"))
    late = predates_lead(F.col(day), F.col("lead_start_date"), limits.max_days_origination_before_lead)
    return days.join(leads, BLOCK).groupBy(*BLOCK, day).agg(F.sum("m").alias("n"), F.sum(F.when(late, F.col("m")).otherwise(0)).alias("late"))


def counted(items: DataFrame, candidates: DataFrame, item_key: list[str], limits: Thresholds) -> DataFrame:
    """(item key, n, late) of each item as `tallied` counts them; null where the block has no candidates."""
    day, own = "primary_origination_date", [c for c in item_key if c not in BLOCK]
    tallies = tallied(items, candidates, limits).withColumnRenamed(day, "__day").withColumnsRenamed({c: f"__{c}" for c in BLOCK})
    same = [F.col(c) == F.col(f"__{c}") for c in BLOCK] + [F.col(day).eqNullSafe(F.col("__day"))]
    return items.select(*BLOCK, *own, day).join(tallies, same, "left").select(*item_key, "n", "late")


def not_surfaced(items: DataFrame, candidates: DataFrame, best: DataFrame, item_key: list[str], limits: Thresholds) -> DataFrame:
    """(item key, reason) of the items without a surfaced match."""
    judged = counted(items, candidates, item_key, limits).join(best.select(*item_key, "decision_band"), item_key, "left")
    excluded = F.when(F.col("late") > 0, F.concat(F.lit(" ("), F.col("late").cast("string"), F.lit(" candidate(s) excluded because the record predates the lead.)"))).otherwise(F.lit(""))
    reason = F.when(F.col("n").isNull(), NO_BLOCK).when(F.col("decision_band").isNull(), F.concat(F.lit(NO_SCORE), excluded)).when(F.col("decision_band") == "discard", BELOW)
    return judged.withColumn("reason", reason).where("reason is not null").select(*item_key, "reason")


def linked(items: DataFrame, candidates: DataFrame, item_key: list[str], limits: Thresholds | None = None, keep: Callable[[DataFrame], DataFrame] = lambda best: best) -> tuple[DataFrame, DataFrame]:
    """(matches in order, items that are not surfaced); both read the best pairs, which `keep` may persist."""
    limits = limits or Thresholds()
    best = keep(best_of_each(scored(items, candidates, item_key, limits), item_key, limits))
    matches = best.where("decision_band <> 'discard'")
    return matches.orderBy("decision_band", F.col("match_score").desc(), F.col("name_score").desc()), not_surfaced(items, candidates, best, item_key, limits)


def with_review_cap(matches: DataFrame, most: int | None) -> tuple[DataFrame, DataFrame]:
    """(matches, review rows beyond the cap); without a cap nothing is held back."""
    if most is None:
        return matches, matches.where(F.lit(False))
    nth = F.row_number().over(Window.partitionBy("decision_band").orderBy(F.col("match_score").desc(), F.col("name_score").desc()))
    over = (F.col("decision_band") == "review") & (F.col("__nth") > most)
    numbered = matches.withColumn("__nth", nth)
    return numbered.where(~over).drop("__nth"), numbered.where(over).drop("__nth")
