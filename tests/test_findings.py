"""What a review found on larger tables."""

import json

from pyspark.sql import functions as F

from linkloom.functions.similarity import token_set_ratio
from linkloom.operators import adjudicate, match
from linkloom.sources import tables

ITEM = ["source_code", "state", "dedupe_name_key"]


def test_a_candidate_with_the_id_0_can_be_chosen(spark):
    rows = spark.createDataFrame([("a", "p", [0, 7]), ("b", "p", [7, 0, -1]), ("c", "p", [7])], "k string, prompt string, offered array<bigint>")
    top = adjudicate.decided(adjudicate.asked(rows, adjudicate.Stub("top"), ["k"], most=None))
    assert {r.k: r.application_id for r in adjudicate.overlay(top, ["k"]).collect()} == {"a": 0, "b": 7, "c": 7}
    none = adjudicate.decided(adjudicate.asked(rows, adjudicate.Stub(), ["k"], most=None)).collect()
    assert {r.k: json.loads(r.payload)["matched_candidate_id"] for r in none} == {"a": -1, "b": -2, "c": 0}
    assert all(r.refused_reason == adjudicate.NO_MATCH and r.chosen is None for r in none)


def test_a_hosted_model_is_told_how_to_say_none():
    sent = []
    model = adjudicate.HostedModel(lambda body: sent.append(body) or {}, "m")
    model.answer("p", [7]), model.answer("p", [0, 7])
    assert ["Answer 0 if none" in b["system"] for b in sent] == [True, False] and "Answer -1 if none" in sent[1]["system"]


def linkage_tables(spark, names=5, items=60, candidates=900):
    """Items and candidates in one large block, a small one and a state without candidates; names repeat."""
    day = lambda c, n: F.date_add(F.lit("2024-01-01").cast("date"), (c % n).cast("int"))
    name = lambda c: F.concat(F.lit("north "), F.chr(F.lit(97) + c % names), F.lit(" mills"))
    place = F.when(F.col("id") % 11 == 0, "OH").otherwise("VA")
    live = spark.range(items).select(
        F.lit("S").alias("source_code"), F.when(F.col("id") % 13 == 0, "XX").otherwise(place).alias("state"), F.concat(name(F.col("id")), F.lit(" "), F.col("id").cast("string")).alias("dedupe_name_key"), name(F.col("id")).alias("live_business_name"),
        F.array(name(F.col("id")), F.concat(F.lit("n"), F.col("id").cast("string"))).alias("live_name_variants"), F.when(F.col("id") % 7 != 0, day(F.col("id"), 50)).alias("primary_origination_date"), (F.col("id") * 10.0).alias("primary_origination_amount"), F.lit("00001; 00002").alias("live_zip_codes"),
    )
    crm = spark.range(candidates).select(
        F.col("id").alias("application_id"), F.col("id").alias("ordinal"), F.lit("S").alias("candidate_source"), place.alias("candidate_state"), name(F.col("id") * 3).alias("crm_business_name"), F.array(name(F.col("id") * 3)).alias("candidate_name_variants"),
        F.when(F.col("id") % 5 != 0, day(F.col("id"), 90)).alias("lead_start_date"), F.lpad((F.col("id") % 4).cast("string"), 5, "0").alias("business_zip_code"), F.lit("$100 - $400").alias("loan_range"),
    )
    return live, crm


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_pairs_are_dealt_out_with_few_copies(spark):
    items, candidates = linkage_tables(spark)
    left, right = items.select(*ITEM), match.candidate_side(candidates).select(*match.BLOCK, "application_id")
    dealt = match.dealt_pairs(left, right, match.BLOCK, ITEM, 100, ["application_id"])
    assert rows_of(dealt.select(*ITEM, "application_id")) == rows_of(left.join(right, match.BLOCK).select(*ITEM, "application_id"))
    copies = []
    plan = dealt._jdf.queryExecution().optimizedPlan()
    for side in (plan.children().apply(0).children().apply(0), plan.children().apply(0).children().apply(1)):
        copies.append(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, side).count())
    assert sum(copies) < 3 * 2 * (900 * 60 / 100 * 900 * 60) ** 0.5  # a side's rows for every part would be over 400,000


def test_pools_are_counted_by_blocks(spark):
    items, candidates = linkage_tables(spark)
    made = adjudicate.pool(items, candidates, ITEM).groupBy(*ITEM).agg(F.count("*").alias("n"), F.max("application_id").alias("last_id"))
    sizes = adjudicate.pool_sizes(items, candidates, ITEM)
    assert rows_of(sizes) == rows_of(made)
    assert sizes.where("state = 'XX'").count() > 0
    assert "Generate" not in sizes._jdf.queryExecution().optimizedPlan().toString()


def test_locations_and_screenings_are_chosen_before_they_meet(spark):
    one = spark.range(1)
    day = lambda c: F.date_add(F.lit("2024-01-01").cast("date"), c.cast("int"))
    lead = one.select(F.lit(1).alias("lead_id"), F.lit("S").alias("source_code"), F.lit("OPEN").alias("status"), F.lit("10k").alias("size_band"), day(F.lit(0)).alias("created_at"), day(F.lit(1)).alias("opened_at"), F.lit("SCREENED").alias("stage"))
    org = spark.createDataFrame([(7, 1, "A", 3), (5, 1, "B", 3)], "organization_id int, lead_id int, name string, person_id int")
    n = F.col("id")
    location = spark.range(3000).select(F.when(n % 2 == 0, 5).otherwise(7).alias("organization_id"), F.lit("BUSINESS").alias("location_type"), F.concat(F.lit("R"), n.cast("string")).alias("region"), F.when(n % 3 == 0, None).otherwise(n % 5).cast("string").alias("postal_code"), F.when(n % 4 != 0, day(n % 9)).alias("created_at"))
    screening = spark.range(3000).select(F.lit(1).alias("lead_id"), F.when(n % 5 != 0, day(n % 7)).alias("created_at"), F.when(n % 2 == 0, "F").alias("first_name"), (n % 11).cast("string").alias("last_name"), F.lit("VA").alias("region"), (n % 6).cast("string").alias("postal_code"), F.lit("1").alias("org_postal_code"))
    source = spark.createDataFrame([("S", "Source")], "code string, display_name string")
    person = spark.createDataFrame([(3, "P", "Q")], "person_id int, first_name string, last_name string")
    got = tables.extract_candidates(lead, org, source, person, location, screening)
    [row] = got.collect()
    pairs = org.join(location, "organization_id").join(screening.withColumnsRenamed({"created_at": "seen_at", "region": "r", "postal_code": "p"}), "lead_id")
    order = [F.col("created_at").desc_nulls_last(), F.col("seen_at").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ("organization_id", "region", "postal_code", "first_name", "last_name", "p")]]
    want = pairs.orderBy(*order).first()
    assert (row.business_id, row.business_state, row.business_zip_code, row.prescreen_created_date, row.prescreen_first_name, row.prescreen_last_name, row.prescreen_zip_code) == (want.organization_id, want.region, want.postal_code, want.seen_at, want.first_name, want.last_name, want.p)
    most = [m.value() for m in joined_rows(got)]
    assert most and max(most) < 3000  # each with each there would be 9,000,000


def joined_rows(df):
    """The row counters of the joins of a frame that was collected through its own plan."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if "Join" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows"))
        todo += [node.children().apply(i) for i in range(node.children().length())]
    return found


def test_offers_meet_names_instead_of_candidates(spark):
    items, candidates = linkage_tables(spark, items=40, candidates=600)
    found = {tuple(r[:3]): [(c.application_id, c.candidate_state, c.business_zip_code, c.name_similarity) for c in r.candidates] for r in adjudicate.offers(items, candidates, ITEM).collect()}
    known = candidates.collect()
    for i in items.collect():
        in_block = [c for c in known if c.candidate_state == i.state] or known
        rated = [(c.application_id, c.candidate_state, c.business_zip_code, round(max(token_set_ratio(a, b) for a in i.live_name_variants for b in c.candidate_name_variants), 2)) for c in in_block]
        assert found[i.source_code, i.state, i.dedupe_name_key] == sorted(rated, key=lambda c: (-c[3], c[0]))[: adjudicate.SHOWN]
    assert len(found) == 40
    named = adjudicate._named_alike(candidates.select("candidate_source", "candidate_state", "application_id", F.col("candidate_name_variants").alias("candidate_names"), F.col("candidate_state").alias("offer_state")), 5, ["application_id"])
    assert named.count() == 2 * 5 and named.selectExpr("max(size(alike))").first()[0] == 5


def test_the_guard_and_blocks_are_counted_without_pairs(spark):
    items, candidates = linkage_tables(spark)
    limits = match.Thresholds()
    pairs = items.join(match.candidate_side(candidates), match.BLOCK)
    late = match.predates_lead(F.col("primary_origination_date"), F.col("lead_start_date"), limits.max_days_origination_before_lead)
    counts = match.counted(items, candidates, ITEM, limits)
    assert rows_of(counts.where("n is not null")) == rows_of(pairs.groupBy(*ITEM).agg(F.count("*").alias("n"), F.count_if(late).alias("late")))
    assert counts.where("late > 0").count() and counts.where("n is null").count() == items.where("state = 'XX'").count()
    blocks = match.block_pairs(items, match.candidate_side(candidates), match.BLOCK).select(*match.BLOCK, "pairs")
    assert rows_of(blocks) == rows_of(pairs.groupBy(*match.BLOCK).agg(F.count("*").alias("pairs")))
