"""Files in, reports out: exports, runs from the command line, decisions, evaluation and adjudication."""

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from linkloom.config import DEFAULT_SOURCES, load_settings
from linkloom.functions import text
from linkloom.operators import adjudicate, evaluate, history, ingest, match, report
from linkloom.plans import ask, run, score
from linkloom.sources import tables


def written(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


HEAD = "Business Name,State,Origination Date,$ disbursed"


def test_exports_are_read_by_their_own_headers(spark, tmp_path):
    written(tmp_path / "Northwest a+b 50%.csv", "Business Name,State,Origination Date,$ disbursed,Zip Code", '"Ironwood, LLC",or,2026-04-05,10,078', '"Two",OR,2026-04-06,11,79')
    written(tmp_path / "Atlantic.csv", "$ disbursed,Notes,State,Origination Date,Business Name", "5,n,va,2026-05-01,Blue Ridge")
    written(tmp_path / "Great Lakes" / "Cover.csv", "nothing")
    written(tmp_path / "Great Lakes" / "Origination Detail.csv", HEAD, "Lake House,WI,2026-05-02,7")
    written(tmp_path / "NWP short.csv", "Business Name,State", "X,OR")
    written(tmp_path / "mystery.csv", HEAD, "Y,OR,2026-05-02,7")
    written(tmp_path / "_hidden.csv", HEAD, "Z,OR,2026-05-02,7")
    files = tables.export_files(spark, tmp_path.as_uri())
    assert [(f.source_file, f.source_sheet) for f in files] == [("Atlantic.csv", "Atlantic"), ("Great Lakes", "Origination Detail"), ("NWP short.csv", "NWP short"), ("Northwest a+b 50%.csv", "Northwest a+b 50%"), ("mystery.csv", "mystery")]
    rows = {(r.source_file, r.source_row_number): (r.live_business_name, r.state, r.disbursed_amount, r.live_zip_code) for r in tables.live_rows(tables.read_exports(spark, files)).collect()}
    assert rows[("Atlantic.csv", 2)] == ("Blue Ridge", "VA", 5.0, "") and rows[("Great Lakes", 2)] == ("Lake House", "WI", 7.0, "")
    assert rows[("Northwest a+b 50%.csv", 2)] == ("Ironwood, LLC", "OR", 10.0, "078") and rows[("Northwest a+b 50%.csv", 3)][0] == "Two"
    settings = load_settings(config(tmp_path / "c"))
    good, wrong = run.loaded(tables.read_exports(spark, files), settings, run.quarter_from_label("2026Q2"), run.described_files(spark, files))
    assert sorted((r.source_file, r.source_code) for r in good.collect()) == [("Atlantic.csv", "ACF"), ("Great Lakes", "GLC"), ("Northwest a+b 50%.csv", "NWP"), ("Northwest a+b 50%.csv", "NWP")]
    assert sorted((r.exception_type, r.source_file, r.detail) for r in wrong.collect()) == [("missing_required_columns", "NWP short.csv", "Origination Date, $ disbursed"), ("unmapped_source_file", "mystery.csv", ingest.UNMAPPED)]
    assert run.loaded_dates(tables.read_exports(spark, files), settings).where("origination_date is not null").count() == 4
    with pytest.raises(ValueError, match="sheet"):
        (tmp_path / "Great Lakes" / "Origination Detail.csv").unlink()
        tables.export_files(spark, tmp_path.as_uri())


def test_rows_are_numbered_over_splits(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        written(tmp_path / name, "n,pad", *[f"{i},{'x' * 50}" for i in range(2, 3000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = tables.numbered(spark.read.schema("n string, pad string").option("header", True).csv(tmp_path.as_uri()))
        assert rows.rdd.getNumPartitions() > 4 and rows.where("cast(n as bigint) <> source_row_number").count() == 0 and rows.count() == 5996
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def config(folder, **more):
    folder.mkdir(parents=True, exist_ok=True)
    raw = {"live_data_dir": (folder / "live").as_uri(), "output_dir": str(folder / "out"), "history_db_path": str(folder / "db" / "history"), "candidates_csv": (folder / "candidates.csv").as_uri(), **more}
    (folder / "settings.json").write_text(json.dumps(raw))
    return str(folder / "settings.json")


def test_settings(tmp_path, monkeypatch):
    plain = load_settings(config(tmp_path))
    assert plain.sources == DEFAULT_SOURCES and (tmp_path / "out").is_dir() and (tmp_path / "db").is_dir() and plain.notifications
    other = load_settings(config(tmp_path, candidates_csv=None, db={"host": "h", "database": "d", "user": "u", "password_env_var": "LINKLOOM_TEST_PW"}, notifications={"enabled": False}))
    assert other.database.url == "jdbc:postgresql://h/d" and not other.notifications
    with pytest.raises(RuntimeError, match="LINKLOOM_TEST_PW"):
        other.database.options()
    monkeypatch.setenv("LINKLOOM_TEST_PW", "x")
    assert other.database.options() == {"user": "u", "password": "x"}


def test_from_the_command_line(spark, tmp_path, capsys):
    c = config(tmp_path)
    written(tmp_path / "live" / "Northwest Q2.csv", HEAD + ",Zip Code", '"Ironwood Bakery, LLC",OR,2026-04-05,90000,78560', "Harbor Dentistry Clinic,OR,2026-05-05,20000,78560", ",OR,2026-05-05,1,", "Early Bird,OR,2026-02-05,5,1")
    names = [f.name for f in tables.CANDIDATE]
    made = [{"application_id": 1001, "candidate_source": "nwp", "crm_business_name": "Ironwood Bakery", "business_state": "OR", "business_zip_code": "78560", "loan_range": "$72,000 - $192,000", "lead_start_date": "2026-01-30"}]
    made += [{"application_id": 1002, "candidate_source": "NWP", "crm_business_name": "Harbor Dental Clinic", "business_state": "OR", "lead_start_date": "2026-03-30"}]
    written(tmp_path / "candidates.csv", ",".join(names), *[",".join(f'"{m.get(n, "")}"' for n in names) for m in made])
    work = ["--config", c, "--work-dir", str(tmp_path / "work")]
    assert run.main([*work, "--quarter", "2026Q2", "--backfill-history", "--queue-logon-notification"]) == 0
    assert run.main([*work, "--show-pending-notification-only"]) == 0 and "2 unresolved" in capsys.readouterr().out
    kept = {r.candidate_application_id: r for r in history.loaded(spark, str(tmp_path / "db" / "history")).collect()}
    assert set(kept) == {1001, 1002} and kept[1001].decision_band == "auto_accept" and kept[1002].decision_band == "review" and kept[1001].source_row_numbers == "2"
    state = json.loads((tmp_path / "work" / "logs" / "run_state.json").read_text())
    assert state["last_completed_quarter"] == "2026Q2" and "matcher_run_current.log" in {p.name for p in (tmp_path / "work" / "logs").iterdir()}
    section = tmp_path / "out" / "match_review_current" / "review"
    edited = spark.read.option("header", True).csv(str(section)).withColumn("status", F.lit("Confirmed")).withColumn("status_note", F.lit("seen")).toPandas()
    for part in section.glob("*"):
        part.unlink()
    edited.to_csv(section / "edited.csv", index=False)
    for hidden in section.glob(".*"):
        hidden.unlink()
    assert run.main([*work, "--quarter", "2026Q2", "--disable-notifications"]) == 0
    kept = {r.candidate_application_id: r for r in history.loaded(spark, str(tmp_path / "db" / "history")).collect()}
    assert (kept[1002].status, kept[1002].status_note, kept[1002].times_seen) == ("confirmed", "seen", 2) and kept[1001].status == "new"
    metrics = {r.metric: r.value for r in spark.read.option("header", True).csv(str(tmp_path / "out" / "match_review_current" / "summary")).collect()}
    assert metrics["imported_status_updates"] == "1" and metrics["live_rows_in_quarter"] == "2" and metrics["exceptions"] == "1" and metrics["current_queue_review"] == "0" and len(metrics) == 19

    truth = tmp_path / "truth.csv"
    written(truth, "source_code,live_business_name,state,expected_application_id,case", 'NWP,"Ironwood Bakery, LLC",OR,1001.0,clean', "NWP,Harbor Dentistry Clinic,OR,1002,misspelling", "NWP,Nobody,OR,,trap")
    where = ["--truth", truth.as_uri(), "--history", str(tmp_path / "db" / "history")]
    assert score.main([*where, "--json-out", str(tmp_path / "e" / "b.json"), "--md-out", str(tmp_path / "e" / "b.md")]) == 0
    found = json.loads((tmp_path / "e" / "b.json").read_text())
    assert found["counts"] == {"resolved_correct": 1, "deferred_correct": 1, "correctly_abstained": 1} and found["metrics"]["automation_rate"] == 50.0 and found["metrics"]["human_queue"] == 1
    assert "| misspelling | " in (tmp_path / "e" / "b.md").read_text()
    assert score.main(["--truth", truth.as_uri(), "--history", str(tmp_path / "none")]) == 1
    assert ask.main([*where, "--candidates", (tmp_path / "candidates.csv").as_uri(), "--stub", "--out", str(tmp_path / "e" / "a.json")]) == 0
    said = json.loads((tmp_path / "e" / "a.json").read_text())
    assert said["usage"]["requests"] == 1 and said["usage"]["refused"] == 1 and said["decisions"][0]["offered"] == [1002, 1001]
    known, candidates = history.loaded(spark, str(tmp_path / "db" / "history")), run.with_candidates(tables.read_candidates(spark, (tmp_path / "candidates.csv").as_uri()))
    helped = score.labelled(tables.read_truth(spark, truth.as_uri()), known, adjudicate.overlay(ask.decisions(known, candidates, adjudicate.Stub("top"), None), ask.KEY))
    assert evaluate.payload(helped)["counts"] == {"resolved_correct": 2, "correctly_abstained": 1}


def test_decisions_of_reports_without_a_key(spark, tmp_path):
    spark.createDataFrame([("x",)], "status string").write.parquet(f"{tmp_path}/review")
    assert report.read_decisions(spark, str(tmp_path)).collect() == [] and report.read_decisions(spark, f"{tmp_path}/none").collect() == []


def test_dealt_pairs_are_all_pairs(spark):
    r = random.Random(3)
    left = spark.createDataFrame([(r.choice(["hot", "hot", "b", "c"]), i) for i in range(200)], "k string, i int")
    right = spark.createDataFrame([(r.choice(["hot", "hot", "b", "d"]), j) for j in range(150)], "k string, j int")
    want = sorted(map(tuple, left.join(right, "k").select("k", "i", "j").collect()))
    for most in (7, 500, 10**6):
        assert sorted(map(tuple, match.dealt_pairs(left, right, ["k"], ["i"], most).select("k", "i", "j").collect())) == want
    assert match.dealt_pairs(left.limit(0), right, ["k"], ["i"]).count() == 0


def test_offers_go_by_business_names_and_raw_ones(spark):
    items = spark.createDataFrame([("s", "VA", "1", "!!!", []), ("s", "VA", "2", "Ann Blue", ["ann blue"])], "source_code string, state string, k string, live_business_name string, live_name_variants array<string>")
    crm = spark.createDataFrame([(1, "s", "VA", "!!!"), (2, "s", "VA", "Ann Blue LLC"), (3, "s", "VA", "Zebra")], "application_id long, candidate_source string, candidate_state string, crm_business_name string")
    crm = crm.withColumn("candidate_name_variants", F.array(F.lit("ann blue")))
    found = {r.k: [c.application_id for c in r.candidates] for r in adjudicate.offers(items, crm, ["source_code", "state", "k"]).collect()}
    assert found["1"][0] == 1 and found["2"][0] == 2


def test_hosted_model():
    sent = []

    def send(body):
        sent.append(body)
        return {"content": [{"type": "text"}, {"type": "tool_use", "name": adjudicate.TOOL, "input": {"matched_candidate_id": 7, "confidence": "high", "reasoning": "r"}}], "usage": {"input_tokens": 5, "output_tokens": 2}}

    answer = adjudicate.HostedModel(send, "some-model").answer("prompt", [7])
    assert json.loads(answer.payload)["matched_candidate_id"] == 7 and (answer.input_tokens, answer.output_tokens) == (5, 2)
    assert sent[0]["tool_choice"]["name"] == sent[0]["tools"][0]["name"] and sent[0]["messages"][0]["content"] == "prompt"
    assert adjudicate.HostedModel(lambda _: {"content": []}, "m").answer("p", []).payload is None


def test_failed_calls_are_errors(spark):
    class Failing:
        def answer(self, prompt, offered):
            raise RuntimeError("no: Bearer abc.def")

    rows = spark.createDataFrame([(1, "p", [7])], "k int, prompt string, offered array<bigint>")
    out = adjudicate.decided(adjudicate.asked(rows, Failing(), ["k"])).first()
    assert out.error == adjudicate.NO_ANSWER and out.call_error == "RuntimeError: no: Bearer [redacted]" and not out.resolved


def test_rounding_is_that_of_exact_values(spark):
    r = random.Random(1)
    values = [r.choice([r.random() * 100, r.randrange(20000) / 200, 200.0 * r.randrange(50) / r.randrange(1, 90)]) for _ in range(2000)] + [2.675, 0.125, 0.375, 66.665, 1.005, 100.0, 0.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", text.round2(F.col("v")).alias("two"), text.rounded(F.col("v"), 1).alias("one")).collect()
    assert all((x.two, x.one) == (round(x.v, 2), round(x.v, 1)) for x in rows)


def test_days_meet_days(spark):
    items = spark.createDataFrame([("s", "VA", "a", date(2026, 1, 1)), ("s", "VA", "b", None), ("s", "OR", "c", date(2026, 1, 1))], "source_code string, state string, k string, primary_origination_date date")
    crm = spark.createDataFrame([(1, "s", "VA", date(2026, 3, 1)), (2, "s", "VA", date(2026, 1, 1)), (3, "s", "VA", None)], "application_id int, candidate_source string, candidate_state string, lead_start_date date")
    best = items.select("source_code", "state", "k").withColumn("decision_band", F.lit(None).cast("string")).limit(0)
    found = {r.k: r.reason for r in match.not_surfaced(items, crm, best, ["source_code", "state", "k"], match.Thresholds()).collect()}
    assert found == {"a": match.NO_SCORE + " (1 candidate(s) excluded because the record predates the lead.)", "b": match.NO_SCORE, "c": match.NO_BLOCK}
