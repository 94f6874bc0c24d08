"""Requests about deferred items to a model, and what its answers amount to."""

from __future__ import annotations

import json
import os
import time
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.similarity import best_token_set
from linkloom.functions.text import name_variants, round2, scrub
from linkloom.operators.match import BLOCK, dealt_pairs

ELIGIBLE = ["review", "possible_match"]
SHOWN = 5
MOST_ROWS = 200
REASONING_CHARS = 400
CONFIDENCES = ["high", "medium", "low"]
# How an answer that resolves nothing is reported.
NO_ANSWER = "model returned no tool call"
OMITTED = "response omitted matched_candidate_id"
NOT_INTEGER = "matched_candidate_id was not an integer: "
NO_MATCH = "model found no matching candidate"
TOO_LOW = "confidence too low to resolve"


@dataclass(frozen=True)
class Answer:
    """A model's JSON (matched_candidate_id, confidence, reasoning; None without any) and what it took."""

    payload: str | None
    input_tokens: int = 0
    output_tokens: int = 0


class Model(Protocol):
    """Answers a prompt about the candidates offered; a failed call raises."""

    def answer(self, prompt: str, offered: list[int]) -> Answer: ...


def none_id(offered: list[int]) -> int:
    """The answer that says none: 0, or where a candidate has that id the next number below that none has."""
    none = 0
    while none in offered:
        none -= 1
    return none


def _none_of(offered: Column) -> Column:
    """`none_id` of a column."""
    free = F.array_except(F.sequence(F.lit(0), -F.size(offered), F.lit(-1)).cast("array<bigint>"), offered)
    return F.coalesce(F.array_max(free), F.lit(0))


class Stub:
    """Declines always, or picks the first candidate."""

    def __init__(self, always: str = "no_match"):
        self.always = always

    def answer(self, prompt: str, offered: list[int]) -> Answer:
        chosen = offered[0] if self.always == "top" and offered else none_id(offered)
        return Answer(f'{{"matched_candidate_id": {chosen}, "confidence": "high", "reasoning": "stub"}}')


TOOL = "record_decision"
INSTRUCTIONS = (
    "Decide whether a source record and one of the candidates are the same business. An automated scorer has left these cases open, so weigh the postal code, the amount against the size band "
    "and the order of dates beside the names, and give shared distinctive words more weight than common ones. Answer {none} if none is clearly the same: a wrong match costs more than none."
)


class HostedModel:
    """A hosted chat model that is made to answer through a tool with a fixed schema.

    `send` posts a request (a dictionary) and returns the response; see `https_sender`. Nothing here holds a key.
    """

    def __init__(self, send: Callable[[dict], dict], model: str, max_tokens: int = 400):
        self.send, self.model, self.max_tokens = send, model, max_tokens

    def request(self, prompt: str, none: int = 0) -> dict:
        properties = {"matched_candidate_id": {"type": "integer", "description": f"id of the matching candidate, {none} for none"}, "confidence": {"type": "string", "enum": CONFIDENCES}, "reasoning": {"type": "string"}}
        schema = {"type": "object", "properties": properties, "required": list(properties)}
        tool = {"name": TOOL, "description": "Records the decision.", "input_schema": schema}
        return {"model": self.model, "max_tokens": self.max_tokens, "system": INSTRUCTIONS.format(none=none), "tools": [tool], "tool_choice": {"type": "tool", "name": TOOL}, "messages": [{"role": "user", "content": prompt}]}

    def answer(self, prompt: str, offered: list[int]) -> Answer:
        response = self.send(self.request(prompt, none_id(offered)))
        used = response.get("usage") or {}
        found = [b.get("input") for b in response.get("content") or [] if b.get("type") == "tool_use" and b.get("name") == TOOL]
        return Answer(json.dumps(found[0] or {}) if found else None, used.get("input_tokens") or 0, used.get("output_tokens") or 0)


def https_sender(url: str, key_variable: str, headers: dict[str, str] | None = None, key_header: str = "x-api-key", timeout: float = 30.0, retries: int = 2) -> Callable[[dict], dict]:
    """Posts JSON to `url`; the key is read from an environment variable at each call."""

    def send(body: dict) -> dict:
        for left in range(retries, -1, -1):
            head = {"content-type": "application/json", key_header: os.environ[key_variable], **(headers or {})}
            try:
                with urllib.request.urlopen(urllib.request.Request(url, json.dumps(body).encode(), head), timeout=timeout) as response:
                    return json.loads(response.read())
            except OSError:
                if not left:
                    raise
        raise AssertionError

    return send


def deferred(history: DataFrame) -> DataFrame:
    return history.where(F.col("decision_band").isin(ELIGIBLE))


def _or_raw(variants: Column, raw: Column) -> Column:
    """A name's variants, or the name as it is where it has none."""
    return F.when(F.size(variants) > 0, variants).otherwise(F.array(F.translate(F.coalesce(raw, F.lit("")), "\x1f", " ")))


def pool(items: DataFrame, candidates: DataFrame, item_key: list[str], candidate_key: str = "application_id") -> DataFrame:
    """Candidates of an item's source and state; of its source alone where there are none."""
    side = candidates.withColumnRenamed("candidate_source", "source_code")
    blocks = side.select("source_code", F.col("candidate_state").alias("state")).distinct()
    near = dealt_pairs(items.join(blocks, BLOCK, "left_semi"), side.withColumnRenamed("candidate_state", "state"), BLOCK, item_key, deal_right_by=[candidate_key])
    alone = dealt_pairs(items.join(blocks, BLOCK, "left_anti"), side.drop("candidate_state"), ["source_code"], item_key, deal_right_by=[candidate_key])
    return near.unionByName(alone, allowMissingColumns=True)


def pool_sizes(items: DataFrame, candidates: DataFrame, item_key: list[str]) -> DataFrame:
    """(item key, n, last_id): how many candidates an item's `pool` has and the greatest id, by counts of blocks instead of pairs."""
    side = candidates.select(F.col("candidate_source").alias("source_code"), F.col("candidate_state").alias("state"), "application_id")
    near = side.groupBy(*BLOCK).agg(F.count("*").alias("near_n"), F.max("application_id").alias("near_id"))
    alone = near.groupBy("source_code").agg(F.sum("near_n").alias("alone_n"), F.max("near_id").alias("alone_id"))
    both = items.select(*dict.fromkeys([*BLOCK, *item_key])).join(near, BLOCK, "left").join(alone, "source_code")
    return both.select(*item_key, F.coalesce("near_n", "alone_n").alias("n"), F.when(F.col("near_n").isNotNull(), F.col("near_id")).otherwise(F.col("alone_id")).alias("last_id"))


def _named_alike(side: DataFrame, shown: int, fields: list[str]) -> DataFrame:
    """(block, candidate_names, first_id, alike): the `shown` first candidates of each block with the same names, in order of their ids.

    No others can be offered, as an item is as like to all of them.
    """
    alike = ["candidate_source", "candidate_state", "candidate_names"]
    first = side.withColumn("nth", F.row_number().over(Window.partitionBy(*alike).orderBy("application_id"))).where(F.col("nth") <= shown)
    rows = F.array_sort(F.collect_list(F.struct("nth", *fields, "offer_state")))
    return first.groupBy(*alike).agg(F.min("application_id").alias("first_id"), rows.alias("alike"))


def offers(items: DataFrame, candidates: DataFrame, item_key: list[str], shown: int = SHOWN) -> DataFrame:
    """For each item the candidates of its pool whose business names are most alike, as an array in order.

    Items meet the names of their pool rather than its candidates: those offered are among the first candidates of
    the `shown` best names, where the smallest id decides between names that are as like.
    """
    own = items.select(*item_key, _or_raw(F.col("live_name_variants"), F.col("live_business_name")).alias("names"))
    fields = [c for c in ("application_id", "crm_business_name", "candidate_state", "business_zip_code", "loan_range", "lead_start_date") if c in candidates.columns]
    side = candidates.select("candidate_source", *fields, _or_raw(name_variants(F.col("crm_business_name")), F.col("crm_business_name")).alias("candidate_names"))
    fields.remove("candidate_state")
    named = _named_alike(side.withColumn("offer_state", F.col("candidate_state")), shown, fields)
    rated = pool(own, named, item_key, "first_id").withColumn("name_similarity", round2(best_token_set(F.col("names"), F.col("candidate_names"))))
    place = lambda c: F.row_number().over(Window.partitionBy(*item_key).orderBy(F.col("name_similarity").desc(), F.col(c)))
    best = rated.drop("names", "candidate_names").withColumn("nth", place("first_id")).where(F.col("nth") <= shown)
    each = best.select(*item_key, "name_similarity", F.inline("alike")).drop("nth")
    top = each.withColumn("nth", place("application_id")).where(F.col("nth") <= shown)
    offered = ["nth", "application_id", "crm_business_name", "name_similarity", F.col("offer_state").alias("candidate_state"), *[c for c in ("business_zip_code", "loan_range", "lead_start_date") if c in fields]]
    return top.groupBy(*item_key).agg(F.array_sort(F.collect_list(F.struct(*offered))).alias("candidates"))


def described(c: Column, fields: list[str]) -> Column:
    """A candidate's line in a prompt; fields that are blank are left out."""
    # How a prompt names the fields.
    labels = {"candidate_state": "state=", "business_zip_code": "postal=", "loan_range": "size_band=", "lead_start_date": "lead_created="}
    bits = [F.concat(F.lit("id="), c["application_id"].cast("string")), F.concat(F.lit('name="'), c["crm_business_name"], F.lit('"'))]
    bits += [F.concat(F.lit(label), F.nullif(c[f].cast("string"), F.lit(""))) for f, label in labels.items() if f in fields]
    bits.append(F.concat(F.lit("name_similarity="), F.replace(F.format_number(c["name_similarity"], 0), F.lit(","), F.lit(""))))
    return F.concat(F.lit("  - "), F.array_join(F.filter(F.array(*bits), lambda b: b.isNotNull()), ", "))


def prompt(name: Column, state: Column, source: Column, postal: Column, amount: Column, dated: Column, candidates: Column, fields: list[str]) -> Column:
    """The text of a request. Its lines and their order."""
    lines = F.concat(
        F.array(
            F.lit("Source record:"),
            F.concat(F.lit('  name="'), name, F.lit('"')),
            F.concat(F.lit("  state="), state),
            F.concat(F.lit("  reported_by="), source),
            F.concat(F.lit("  postal="), F.nullif(postal, F.lit(""))),
            F.concat(F.lit("  amount="), F.format_number(amount, 0)),
            F.concat(F.lit("  dated="), F.nullif(dated, F.lit(""))),
            F.lit(""),
            F.concat(F.lit("Candidates ("), F.size(candidates).cast("string"), F.lit("):")),
        ),
        F.transform(F.slice(candidates, 1, SHOWN), lambda c: described(c, fields)),
        F.array(F.lit(""), F.lit("Which candidate, if any, is the same business? Record your decision.")),
    )
    return F.array_join(F.filter(lines, lambda x: x.isNotNull()), "\n")


def _quoted(text: Column) -> Column:
    """A string as an error shows it: in single quotes, or double ones if it has single ones only."""
    plain = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    single, double = F.contains(text, F.lit("'")), F.contains(text, F.lit('"'))
    inner = F.when(single & double, F.replace(plain, F.lit("'"), F.lit("\\'"))).otherwise(plain)
    return F.when(single & ~double, F.concat(F.lit('"'), inner, F.lit('"'))).otherwise(F.concat(F.lit("'"), inner, F.lit("'")))


def decided(answers: DataFrame, payload: str = "payload", offered: str = "offered") -> DataFrame:
    """`answers` with resolved, chosen, confidence, refused_reason, error and reasoning.

    The tests come in this order: no answer, a missing id, one that is no integer, the answer for none (`none_id`), one
    that was not offered, low confidence. A number counts by its integer part and a string if it spells an integer; null is no integer.
    """
    value = F.try_variant_get(F.try_parse_json(payload), "$.matched_candidate_id", "variant")
    kind, raw = F.schema_of_variant(value), F.get_json_object(payload, "$.matched_candidate_id")
    said = F.lower(F.coalesce(F.get_json_object(payload, "$.confidence"), F.lit("low")))
    sure = F.when(said.isin(CONFIDENCES), said).otherwise(F.lit("low"))
    spelled = F.when(raw.rlike(r"^\s*[+-]?\d+(_\d+)*\s*$"), F.replace(F.trim(F.regexp_replace(raw, r"\s", "")), F.lit("_"), F.lit("")).try_cast("bigint"))
    number = F.when(kind == "STRING", spelled).when(kind == "BOOLEAN", (raw == "true").cast("bigint")).when(kind == "BIGINT", raw.try_cast("bigint")).when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), raw.try_cast("double").cast("bigint"))
    shown = F.when(kind == "VOID", "None").when(kind == "STRING", _quoted(raw)).otherwise(raw)
    error = F.when(F.try_parse_json(payload).isNull(), NO_ANSWER).when(value.isNull(), OMITTED).when(number.isNull(), F.concat(F.lit(NOT_INTEGER), shown))
    judged = answers.withColumns({"confidence": sure, "error": error, "chosen": number, "reasoning": F.substring(F.coalesce(F.get_json_object(payload, "$.reasoning"), F.lit("")), 1, REASONING_CHARS)})
    chosen, strange, none = F.col("chosen"), ~F.array_contains(F.col(offered), F.col("chosen")), _none_of(F.col(offered))
    refused = F.when(chosen == none, NO_MATCH).when(strange, F.concat(F.lit("id "), chosen.cast("string"), F.lit(" was not among the candidates offered"))).when(F.col("confidence") == "low", TOO_LOW)
    reasoned = judged.withColumn("refused_reason", F.when(F.col("error").isNull(), refused))
    return reasoned.withColumn("resolved", F.col("error").isNull() & F.col("refused_reason").isNull()).withColumn("chosen", F.when(F.col("error").isNull() & (chosen != none) & ~strange, chosen))


def unasked(requests: DataFrame, item_key: list[str], most: int | None = MOST_ROWS) -> DataFrame:
    """The requests that `asked` leaves out under the same cap."""
    return requests.limit(0) if most is None else requests.orderBy(*item_key).offset(most)


def asked(requests: DataFrame, model: Model, item_key: list[str], most: int | None = MOST_ROWS) -> DataFrame:
    """Answers to at most `most` requests (the cap on paid calls; None for all), with errors scrubbed; see `unasked`."""
    import pandas as pd

    first = requests if most is None else requests.orderBy(*item_key).limit(most)
    slim = first.select(*item_key, "prompt", "offered")
    schema = slim.selectExpr("*", "cast(null as string) as payload", "cast(null as string) as call_error", "0L as input_tokens", "0L as output_tokens", "0L as latency_ms").schema

    def run(batches):
        for frame in batches:
            answers, errors, took = [], [], []
            for text, offered in zip(frame["prompt"], frame["offered"], strict=True):
                began = time.perf_counter()
                try:
                    answers.append(model.answer(text, list(offered)))
                    errors.append("")
                except Exception as e:  # a call that fails is an answer with an error
                    answers.append(Answer(None))
                    errors.append(f"{type(e).__name__}: {e}")
                took.append(int((time.perf_counter() - began) * 1000))
            yield pd.DataFrame(frame).assign(payload=[a.payload for a in answers], call_error=errors, input_tokens=[a.input_tokens for a in answers], output_tokens=[a.output_tokens for a in answers], latency_ms=took)

    return slim.mapInPandas(run, schema).withColumn("call_error", scrub(F.col("call_error")))


def requests_of(items: DataFrame, offered: DataFrame, item_key: list[str]) -> DataFrame:
    """(item key, prompt, offered) for each item with offers."""
    both = items.join(offered, item_key)
    dated = F.date_format("primary_origination_date", "yyyy-MM-dd")
    names = [f.name for f in offered.schema["candidates"].dataType.elementType]
    text = prompt(F.col("live_business_name"), F.col("state"), F.coalesce(F.nullif("source_name", F.lit("")), F.col("source_code")), F.lit(""), F.nullif("primary_origination_amount", F.lit(0.0)), dated, F.col("candidates"), names)
    return both.select(*item_key, text.alias("prompt"), F.transform("candidates", lambda c: c["application_id"]).alias("offered"))


def totals(decisions: DataFrame) -> DataFrame:
    """One row: how requests ended, and what they took where the answers say so."""
    sums = [F.sum(c).alias(c) for c in ("input_tokens", "output_tokens", "latency_ms") if c in decisions.columns]
    return decisions.agg(F.count("*").alias("requests"), F.count_if("resolved").alias("resolved"), F.count_if(F.col("refused_reason").isNotNull()).alias("refused"), F.count_if(F.col("error").isNotNull()).alias("errors"), *sums)


def overlay(decisions: DataFrame, item_key: list[str]) -> DataFrame:
    """What resolved requests say: (item key, application_id)."""
    return decisions.where("resolved").select(*item_key, F.col("chosen").alias("application_id"))
