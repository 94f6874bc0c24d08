"""Quality rules as a bitmask ledger, with DataFrame functions only.

Every rule is evaluated once for each document. The ledger keeps the measurements and one long, `fails`, whose
bit k is set if rule k fails. A policy is a version, a mask of the rules that reject and the number of them
that must fail; applying one, or measuring what each of its rules adds, reads the ledger's bits only.

Words are `[^\\x20\\x09-\\x0D]+`. Repeated windows are found within the row: the windows of five words are hashed to
64 bits, and rows with equal hashes have the windows sorted by hash, words and place, so that equal ones stand side
by side; their words are compared, so that a clash of hashes counts for nothing. The places covered add up without a
shuffle, however long the text is.

Edge cases: a null text counts as empty, has no words and fails the rules that ask for words; repeated rows
are judged alike; an empty table gives no rows. `with_ledger` replaces a column that has the name of its result,
as withColumn does; all other columns stay, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import SPACES, spare_names, table

REPEAT_WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Fails where `test`, SQL over the measurements, holds."""

    name: str
    test: str


#: Fixed order: a rule's place is its bit in the ledger, so rules are only added at the end.
RULES = (
    Rule("too_few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words and n_symbols > 3"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("short_words", "10 * word_chars < 15 * n_words"),
    Rule("few_letters", "2 * n_letters < word_chars"),
)
BITS = {r.name: 1 << k for k, r in enumerate(RULES)}
BASE = BITS["too_few_words"] | BITS["repeated_words"]


@dataclass(frozen=True)
class Policy:
    """Rejects a document if at least `least` of the rules in `mask` fail."""

    version: str
    mask: int
    least: int = 1


POLICIES = {
    "base-1": Policy("base-1", BASE),
    "strict-1": Policy("strict-1", (1 << len(RULES)) - 1),
    "corpus-1": Policy("corpus-1", BASE | BITS["symbols"] | BITS["duplicate_lines"] | BITS["long_words"] | BITS["few_letters"]),
}
PRODUCTION = POLICIES["corpus-1"]


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """`of(value)` with `value` worked out once, however often `of` uses it."""
    return F.transform(F.array(value), of)[0]


def window_hashes(words: Column, size: int = REPEAT_WINDOW) -> Column:
    """Hashes of all windows of `size` words, in order, made of the words' hashes."""

    def hashes(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))
        return F.when(F.size(h) >= size, each).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), hashes)


def covered_words(words: Column, size: int = REPEAT_WINDOW) -> Column:
    """How many words lie in windows that occur twice or more."""

    def repeated(windows: Column) -> Column:
        same = lambda p, k: F.coalesce((p["h"] == F.get(windows, k)["h"]) & (p["w"] == F.get(windows, k)["w"]), F.lit(False))
        twice = F.filter(windows, lambda p, k: F.when(k > 0, same(p, k - 1)).otherwise(F.lit(False)) | same(p, k + 1))
        return F.array_sort(F.transform(twice, lambda p: p["i"]))

    def total(places: Column) -> Column:
        gaps = F.transform(places, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(places, k + 1) - p, F.lit(size))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda n, g: n + g)

    def of(w: Column) -> Column:
        windows = lambda h: F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), F.slice(w, i + 1, size).alias("w"), i.alias("i"))))
        some = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(let(windows(h), repeated), total)).otherwise(F.lit(0).cast("bigint"))
        return let(window_hashes(w, size), some)

    return let(words, of)


def measured(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, Column], list[str]]:
    """`docs` with columns of words and lines, the measurements over them, and the names of these columns."""
    names = spare_names(docs.columns, "words", "lines")
    t, words, lines = F.coalesce(F.col(text), F.lit("")), F.col(names[0]), F.col(names[1])
    held = docs.withColumns(
        {
            names[0]: F.filter(F.split(t, SPACES), lambda w: w != ""),
            names[1]: F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
        }
    )
    measures = {
        "n_words": F.size(words),
        "word_chars": F.length(F.regexp_replace(t, SPACES, "")),
        "n_symbols": F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": covered_words(words),
        "n_letters": F.length(F.regexp_replace(t, "[^\\p{L}]+", "")),
    }
    return held, {k: v.cast("bigint") for k, v in measures.items()}, names


def with_ledger(docs: DataFrame, text: str = "text", out: str = "ledger") -> DataFrame:
    """`docs` with a struct column `out`: the measurements, and `fails` with a bit for each rule."""
    held, measures, used = measured(docs, text)
    names = dict(zip(measures, spare_names([*held.columns, out], *measures), strict=True))
    named = held.withColumns({names[k]: v for k, v in measures.items()})
    fails = F.lit(0).cast("bigint")
    for rule in RULES:
        bit = F.when(F.expr(_over(rule.test, names)), F.lit(BITS[rule.name])).otherwise(F.lit(0)).cast("bigint")
        fails = fails.bitwiseOR(bit)
    ledger = F.struct(*[F.col(name).alias(k) for k, name in names.items()], fails.alias("fails"))
    return named.withColumn(out, ledger).drop(*used, *names.values())


def _over(test: str, names: dict[str, str]) -> str:
    """The test over the columns that hold the measurements."""
    return re.sub(r"\b(" + "|".join(sorted(names, key=len, reverse=True)) + r")\b", lambda m: names[m[1]], test)


def rejected(fails: Column, policy: Policy) -> Column:
    """Whether the policy rejects a document with these bits."""
    return F.bit_count(fails.bitwiseAND(F.lit(policy.mask).cast("bigint"))) >= policy.least


def applied(ledger: DataFrame, policies: list[Policy], fails: str = "ledger.fails") -> DataFrame:
    """The ledger with a boolean `kept_<version>` for each policy."""
    return ledger.select("*", *[(~rejected(F.col(fails), p)).alias("kept_" + p.version.replace("-", "_")) for p in policies])


def ablation(ledger: DataFrame, policy: Policy, fails: str = "ledger.fails") -> DataFrame:
    """For each rule of the policy: documents failing it, rejected by the policy, and kept if the rule were left out.

    Documents are first counted by their bits, of which there are at most 2^rules; the rest works on these counts.
    """
    counts = ledger.groupBy(F.col(fails).bitwiseAND(F.lit(policy.mask).cast("bigint")).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(BITS[r.name]).cast("bigint").alias("bit")) for r in RULES if policy.mask & BITS[r.name]])
    each = counts.select("bits", "n", F.inline(rules))
    fails_it = F.col("bits").bitwiseAND(F.col("bit")) != 0
    gone = rejected(F.col("bits"), policy)
    saved = gone & ~(F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not("bit"))) >= policy.least)
    return each.groupBy("rule").agg(
        F.sum(F.when(fails_it, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(gone, F.col("n")).otherwise(0)).alias("rejected"),
        F.sum(F.when(saved, F.col("n")).otherwise(0)).alias("only_by_this"),
        F.bit_or(F.when(fails_it, F.col("bits")).otherwise(F.lit(0).cast("bigint"))).alias("fails_with"),
    )


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    ledger = with_ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    fails = F.col("ledger.fails")
    return ledger.select(
        "doc_id",
        *[F.col(f"ledger.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (fails.bitwiseAND(F.lit(BASE).cast("bigint")) != 0).alias("base_failed"),
        (~rejected(fails, PRODUCTION)).alias("kept"),
        fails.alias("fails"),
    )


OP1_SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc WHERE len(w) >= 5)
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p FROM win JOIN (SELECT doc_id, s FROM win GROUP BY doc_id, s HAVING count(*) > 1) USING (doc_id, s)) GROUP BY doc_id
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines, length(regexp_replace(t, '[^\p{L}]+', '', 'g'))::BIGINT AS n_letters
  FROM doc LEFT JOIN rep USING (doc_id)
), f AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words AND n_symbols > 3 THEN 4 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END + CASE WHEN 10 * word_chars < 15 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 2 * n_letters < word_chars THEN 64 ELSE 0 END)::BIGINT AS fails FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fails & 3) <> 0 AS base_failed, (fails & 95) = 0 AS kept, fails FROM f
"""
