"""String similarities on a scale of 0 to 100.

`ratio` is 200 * LCS / (sum of lengths). The vectorised route finds longest common subsequences by bit-parallel
rows on Python integers; `lcs_native` does the same with DataFrame functions and is kept as a cross-check.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.text import LEGAL_SUFFIXES, STOPWORDS, let

_MEMO = 200_000
_DROPPED = frozenset(LEGAL_SUFFIXES) | frozenset(STOPWORDS)


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@lru_cache(maxsize=_MEMO)
def ratio(a: str, b: str) -> float:
    size = len(a) + len(b)
    return 100.0 if not size else 200.0 * lcs(a, b) / size


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best of comparing what both share with what each has besides."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_a, only_b = x & y, " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and not (only_a and only_b):
        return 100.0
    shared = len(" ".join(sorted(both)))
    gap = 1 if shared else 0
    size_a, size_b = shared + gap + len(only_a), shared + gap + len(only_b)
    indel = len(only_a) + len(only_b) - 2 * lcs(only_a, only_b)
    best = 100.0 - 100.0 * indel / (size_a + size_b)
    if shared:
        best = max(best, 100.0 - 100.0 * (gap + len(only_a)) / (shared + size_a), 100.0 - 100.0 * (gap + len(only_b)) / (shared + size_b))
    return best


def _windows(short: str, long: str) -> float:
    """Best ratio of `short` with a window of `long`; a window that ends in a character that `short` lacks is no better than the one before."""
    if short in long:
        return 100.0
    n, where = len(short), {}
    for i, c in enumerate(short):
        where[c] = where.get(c, 0) | 1 << i
    masks = [where.get(c, 0) for c in long]
    full, best = (1 << n) - 1, 0.0
    for end in range(1, len(long) + n):
        if end <= len(long) and not masks[end - 1]:
            continue
        window = masks[max(0, end - n) : end]
        row = full
        for m in window:
            hit = row & m
            row = ((row + hit) | (row - hit)) & full
        best = max(best, 200.0 * (n - row.bit_count()) / (n + len(window)))
    return best


@lru_cache(maxsize=_MEMO)
def partial_ratio(a: str, b: str) -> float:
    """The shorter text against every stretch of the longer one of its length, and shorter ones at the ends."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    if len(a) == len(b):
        return max(_windows(a, b), _windows(b, a))
    return _windows(a, b) if len(a) < len(b) else _windows(b, a)


@lru_cache(maxsize=_MEMO)
def _kept(variant: str) -> tuple[str, frozenset[str]]:
    """Core text of a normalised variant, and its tokens."""
    words = [w for w in variant.split() if w not in _DROPPED]
    return " ".join(words), frozenset(words)


@lru_cache(maxsize=_MEMO)
def variant_score(a: str, b: str, floor: float = 0.0) -> float:
    """How alike two normalised variants are; below `floor`, a number below it.

    Without a core token in common the cores' ratio is all that can be had, so that it is tried first.
    """
    (core_a, x), (core_b, y) = _kept(a), _kept(b)
    exact = 100.0 if a == b else 0.0
    overlap = 100.0 * len(x & y) / len(x | y) if x | y else 0.0
    contain = bool(x and y) and (x <= y or y <= x)
    most = 100.0
    if overlap == 0 and not contain and exact != 100:
        most = ratio(core_a, core_b) if core_a or core_b else ratio(a, b)
        if most < floor:
            return most
    combo = 0.45 * token_set_ratio(a, b) + 0.20 * token_sort_ratio(a, b) + 0.35 * overlap
    score = max(exact, ratio(a, b), combo)
    if score < 92 and (overlap >= 50 or contain or exact == 100):  # 92 is all that the partial ratio can give
        score = max(score, 0.92 * partial_ratio(a, b))
    return min(score, most)


@lru_cache(maxsize=_MEMO)
def best_pair(live: tuple[str, ...], candidate: tuple[str, ...], floor: float = 0.0) -> tuple[float, str, str]:
    """The best score over pairs of variants; the first such pair in order, or blanks if all are 0 (or below `floor`)."""
    best, pair = 0.0, ("", "")
    for a in live:
        for b in candidate:
            score = variant_score(a, b, floor)
            if score > best and score >= floor:
                best, pair = score, (a, b)
            if best >= 100:  # none can be better, and the first of equals counts
                return best, *pair
    return best, *pair


@lru_cache(maxsize=_MEMO)
def has_name_signal(live: str, candidate: str, name_score: float) -> bool:
    """Whether the winning pair has more in common than filler words."""
    (core_a, x), (core_b, y) = _kept(live), _kept(candidate)
    if x & y:
        return True
    if not core_a or not core_b:
        return ratio(live, candidate) >= 90
    tight_a, tight_b = core_a.replace(" ", ""), core_b.replace(" ", "")
    if tight_a in tight_b or tight_b in tight_a:
        return True
    whole = ratio(core_a, core_b)
    if whole >= 85:
        return True
    part = partial_ratio(core_a, core_b)
    return part >= 92 or (name_score >= 80 and max(whole, part) >= 80)


def _pairwise(function):
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            yield pa.array([None if a is None or b is None else function(a, b) for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True)], pa.float64())

    return run


def similarity(kind: str, a: Column, b: Column) -> Column:
    """One of ratio, token_sort_ratio, token_set_ratio, partial_ratio, variant_score of two texts."""
    known = {"ratio": ratio, "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio, "partial_ratio": partial_ratio, "variant_score": variant_score}
    return F.arrow_udf(_pairwise(known[kind]), "double")(a, b)


_MARK = "\x1f"  # between the variants of a list; normalised names don't have it


def _listed(joined: str | None) -> tuple[str, ...]:
    return tuple(joined.split(_MARK)) if joined else ()


def _joined(variants: Column) -> Column:
    """Variants as one text, which goes to Python and back to mind faster than a list."""
    return F.array_join(variants, _MARK)


@lru_cache(maxsize=_MEMO)
def matched(live: str | None, candidate: str | None, floor: float) -> tuple[float, str, str, bool]:
    """name_score, the winning variants and the guard for two joined lists of variants."""
    score, x, y = best_pair(_listed(live), _listed(candidate), floor)
    shown = round(score, 2)
    return shown, x, y, has_name_signal(x, y, shown)


def _score_batches(floor: float):
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for live, candidate in batches:
            rows = [matched(a, b, floor) for a, b in zip(live.to_pylist(), candidate.to_pylist(), strict=True)]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.float64(), pa.string(), pa.string(), pa.bool_()]
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["name_score", "live_variant", "candidate_variant", "signal"])

    return run


def name_match(live_variants: Column, candidate_variants: Column, floor: float = 0.0) -> Column:
    """struct<name_score, live_variant, candidate_variant, signal> for two arrays of variants; those that can't reach `floor` score 0.

    The floor is taken half a hundredth lower, as scores are rounded before they are compared with it. Marked as
    not deterministic, so that a filter on it isn't pushed below an exchange and worked out twice.
    """
    kind = "struct<name_score:double,live_variant:string,candidate_variant:string,signal:boolean>"
    return F.arrow_udf(_score_batches(max(floor - 0.005, 0.0)), kind).asNondeterministic()(_joined(live_variants), _joined(candidate_variants))


@lru_cache(maxsize=_MEMO)
def _token_set(a: str, b: str) -> float:
    return token_set_ratio(a, b)


@lru_cache(maxsize=_MEMO)
def _best_token_set(live: str | None, candidate: str | None) -> float:
    return max((_token_set(a, b) for a in _listed(live) for b in _listed(candidate)), default=0.0)


def _best_token_sets(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for live, candidate in batches:
        yield pa.array([_best_token_set(x, y) for x, y in zip(live.to_pylist(), candidate.to_pylist(), strict=True)], pa.float64())


def best_token_set(live_variants: Column, candidate_variants: Column) -> Column:
    """The greatest token set ratio over pairs of variants."""
    return F.arrow_udf(_best_token_sets, "double")(_joined(live_variants), _joined(candidate_variants))


def lcs_native(a: Column, b: Column) -> Column:
    """Longest common subsequence with DataFrame functions: a row of the table for each character of `a`."""

    def table(bs: Column) -> Column:
        n = F.size(bs)
        zero = F.array_repeat(F.lit(0), n + 1)

        def row(before: Column, c: Column) -> Column:
            def cell(done: Column, j: Column) -> Column:
                up, left, corner = F.get(before, j), F.element_at(done, -1), F.get(before, j - 1)
                return F.array_append(done, F.when(F.get(bs, j - 1) == c, corner + 1).otherwise(F.greatest(up, left)))

            return F.aggregate(F.sequence(F.lit(1), n), F.array(F.lit(0)), cell)

        last = F.aggregate(F.split(a, ""), zero, row)
        return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(F.element_at(last, -1))

    return let(F.split(b, ""), table)
