"""Secret scans: fixed patterns, and password guess costs for values in a credential's context.

The base kinds are patterns: assign, access and hex. Beyond them, each value that follows a word such as
`password`, `pwd`, `passphrase` or `bearer` is priced: a dynamic programme finds the cheapest segmentation
of the value into words, dates, repeats, keyboard or alphabet walks and brute-force spans, where the cost
of a segment is the logarithm of the guesses that it takes. A value whose cheapest segmentation needs
`GUESS_BITS` or more is reported as kind `guess`: weak or ordinary values after such a word are left alone.

The words are ranked: common passwords first (`WORDS`), then the `LEXICON_WORDS` commonest words that occur
`LEAST_COUNT` times or more in the texts themselves, counted over all of them (values in a credential's
context aside, so that a secret with many copies does not become a word). The lexicon is broadcast; its size
is bounded by these numbers.

Spans are (kind, start, end) in code points, end exclusive, of the match (of the value for kind guess), in
the order of their start and then of `KINDS`. A guess that lies within a base span is not added.

Edge cases: a null text is empty and has no spans; texts are scanned whole, and values of any length are
priced whole (or until no cheaper ending can bring them below the threshold); an empty table has no words and
gives no rows; repeated rows get the same result. `with_secrets` replaces a column that has the name of its
result, as withColumn does; all other columns stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import frequent, slices, table, word_counts

KINDS = ("assign", "access", "hex", "guess")
GUESS_BITS = 40.0
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{16}")
_HEX_RUN = re.compile(r"[0-9a-f]{16,}")  # the same runs as [0-9a-f]+ of 16 or more
_CONTEXT_WORDS = (b"pass", b"pwd", b"secret", b"token", b"key", b"cred", b"bearer", b"auth", b"login")
#: A credential's word that no letter or digit precedes (db_password and db-password do), and the value after it.
_CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:password|passwd|passphrase|passcode|pwd|pass|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|bearer|auth|login)"""
    r"""["']?(?:\x20*(?:[:=]|=>|:=)\x20*|(?<=[Bb]earer)\x20+)["']?([\x21\x23-\x26\x28-\x7E]{8,})""",
    re.IGNORECASE | re.ASCII,
)
LEXICON_WORDS = 20_000
LEAST_COUNT = 20
SHORTEST, LONGEST = 3, 16
_LETTERS = bytes(b if 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

#: Common words and passwords, the commonest first; the guesses of a word are its place.
WORDS = (
    "password", "qwerty", "dragon", "master", "monkey", "letmein", "login", "princess", "football", "shadow", "sunshine", "welcome", "admin",
    "secret", "hello", "freedom", "whatever", "trustno", "summer", "winter", "spring", "autumn", "super", "test", "user", "guest", "root",
    "changeme", "default", "example", "sample", "null", "none", "true", "false", "required", "optional", "string", "value", "field", "forgot",
    "reset", "token", "api", "key", "pass", "word", "access", "the", "and", "you", "your", "for", "with", "this", "that", "from", "have", "is",
    "not", "love", "home", "work", "house", "computer", "internet", "server", "client", "database", "system", "service", "google", "company",
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december", "monday",
    "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "red", "green", "blue", "black", "white", "correct", "horse",
    "battery", "staple", "baseball", "soccer", "michael", "jordan", "jennifer", "hunter", "ranger", "buster", "thomas", "robert", "batman",
    "superman", "pepper", "ginger", "cookie", "banana", "orange", "cheese", "coffee", "please", "enter", "here", "insert", "replace",
)
_RANK = {w: i + 1 for i, w in enumerate(WORDS)}  # without a corpus
_LEET = str.maketrans("4@310$57!", "aaeiossti")
_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz", "0123456789")
_NEXT = {(r[i], r[i + 1]) for r in _ROWS for i in range(len(r) - 1)} | {(r[i + 1], r[i]) for r in _ROWS for i in range(len(r) - 1)}
_DATE = re.compile(r"(?:19|20)\d\d|(?:0[1-9]|[12]\d|3[01])[./-]?(?:0[1-9]|1[0-2])[./-]?(?:(?:19|20)?\d\d)|(?:19|20)\d\d[./-]?(?:0[1-9]|1[0-2])[./-]?(?:0[1-9]|[12]\d|3[01])")


def _alphabet(c: str) -> float:
    return math.log2(10 if c.isdigit() else 26 if c.isalpha() else 33)


def words_of(raw: bytes | None) -> list[bytes]:
    """Lower-case words of letters; values in a credential's context are left out."""
    if raw and any(k in raw.lower() for k in _CONTEXT_WORDS):
        raw = _CONTEXT.sub(" ", raw.decode("utf-8", "replace")).encode()
    return (raw or b"").translate(_LETTERS).split()


def may_be_listed(word: bytes) -> bool:
    return SHORTEST <= len(word) <= LONGEST


def ranked(words: list[str]) -> dict[str, int]:
    """Place of each word, the common passwords before `words`, which are in order of their frequency."""
    return {w: i + 1 for i, w in enumerate(dict.fromkeys([*WORDS, *words]))}


def learned_words(docs: DataFrame, text: str = "text", most: int = LEXICON_WORDS, least: int = LEAST_COUNT) -> dict[str, int]:
    """The ranked lexicon of all texts of `docs`."""
    return ranked([w.decode() for w, _ in frequent(word_counts(docs, words_of, may_be_listed, text), most, least)])


def _short_segments(s: str, rank: dict[str, int] = _RANK) -> Iterator[tuple[int, int, float]]:
    """(start, end, bits) of words and dates, by their start."""
    low, n = s.lower(), len(s)
    plain = low.translate(_LEET)
    forms = ((low, 0.0),) if plain == low else ((low, 0.0), (plain, 2.0))  # the same word is not cheaper the second time
    place_of = rank.get
    for i in range(n):
        for form, more in forms:
            for j in range(i + SHORTEST, min(n, i + LONGEST) + 1):
                if (place := place_of(form[i:j])) is not None:
                    upper = sum(c.isupper() for c in s[i:j])
                    case = 0.0 if upper == 0 else 1.0 if upper == j - i or s[i].isupper() and upper == 1 else 2.0 + upper
                    yield i, j, math.log2(place) + 1 + more + case
        if s[i] in "0123" and (m := _DATE.match(s, i)):
            yield i, m.end(), 8.0 if m.end() - i == 4 else 15.0


class _Stretch:
    """A longest stretch of equal characters, of a repeated group or of a walk: every part of it that has `least`
    characters or more, and a multiple of `step`, is a segment of fixed + slope * log2(length / step) bits."""

    def __init__(self, start: int, end: int, step: int, least: int, fixed: Callable[[int], float], slope: float):
        self.start, self.end, self.step, self.least, self.fixed, self.slope = start, end, step, least, fixed, slope
        self.live: dict[int, list[tuple[int, float]]] = {}

    def bits(self, i: int, j: int) -> float:
        return self.fixed(i) + self.slope * math.log2((j - i) / self.step)

    def cheapest(self, j: int, best: list[float]) -> float:
        """The least best[i] + bits(i, j), for j = start, start + 1, ... in turn.

        Costs are concave in the length, so what an earlier start costs more than a later one only falls as j
        grows: a start that is no better than an earlier one when it first counts never is, and an earlier one
        that is no better at the stretch's end was not before. Neither is held, so that few starts are.
        """
        i = j - self.least
        if i < self.start:
            return math.inf
        held = self.live.setdefault((j - self.start) % self.step, [])
        new = best[i] + self.fixed(i)
        cost = lambda start, base, end: base + self.slope * math.log2((end - start) / self.step)
        least = min((cost(a, base, j) for a, base in held), default=math.inf)
        if cost(i, new, j) < least:
            last = self.end - (self.end - j) % self.step
            held[:] = [(a, base) for a, base in held if cost(a, base, last) < cost(i, new, last)] + [(i, new)]
            least = cost(i, new, j)
        return least


def _stretches(s: str, rank: dict[str, int] = _RANK) -> Iterator[_Stretch]:
    low, n = s.lower(), len(s)
    groups: dict[str, float] = {}

    def group_bits(group: str) -> float:
        if group not in groups:
            groups[group] = guess_bits(group, rank)
        return groups[group]

    def runs(gap: int, linked: Callable[[int], bool]) -> Iterator[tuple[int, int]]:
        """Longest (start, end) in which each character is linked to the one `gap` before it."""
        j = gap
        while j < n:
            if linked(j):
                start = j - gap
                while j < n and linked(j):
                    j += 1
                yield start, j
            j += 1

    for a, b in runs(1, lambda j: low[j] == low[j - 1]):
        if b - a >= 3:
            yield _Stretch(a, b, 1, 3, lambda i: _alphabet(s[i]), 1.0)
    for size in range(2, min(LONGEST, n // 2) + 1):  # a repeated group, which is priced on its own
        for a, b in runs(size, lambda j, size=size: low[j] == low[j - size]):
            if b - a >= 2 * size:
                yield _Stretch(a, b, size, 2 * size, lambda i, size=size: group_bits(s[i : i + size]), 1.0)
    for a, b in runs(1, lambda j: (low[j - 1], low[j]) in _NEXT):
        if b - a >= 3:
            yield _Stretch(a, b, 1, 3, lambda i: 6.0, 1.5)


def _segments(s: str, rank: dict[str, int] = _RANK) -> Iterator[tuple[int, int, float]]:
    """(start, end, bits) of every segment that is cheaper than brute force."""
    yield from _short_segments(s, rank)
    for x in _stretches(s, rank):
        for i in range(x.start, x.end):
            for j in range(i + x.least, x.end + 1, x.step):
                yield i, j, x.bits(i, j)


def guess_bits(value: str, rank: dict[str, int] = _RANK, enough: float = math.inf) -> float:
    """log2 of the guesses that the cheapest segmentation of `value` takes, or a number from `enough` on if it takes that many.

    No segment but a stretch is longer than `LONGEST`, and none costs less than nothing: where no stretch goes on and
    the last `LONGEST` prefixes all cost `enough`, so does the whole.
    """
    n = len(value)
    short = _short_segments(value, rank)
    ending: dict[int, list[tuple[int, float]]] = defaultdict(list)
    ahead = next(short, None)
    begins: dict[int, list[_Stretch]] = defaultdict(list)
    for x in _stretches(value, rank):
        begins[x.start].append(x)
    best, around, dear = [0.0] + [math.inf] * n, [], 0
    for j in range(1, n + 1):
        while ahead and ahead[0] < j:  # segments that start before j
            ending[ahead[1]].append((ahead[0], ahead[2]))
            ahead = next(short, None)
        if around or j - 1 in begins:
            around = [x for x in around if x.end >= j] + begins.get(j - 1, [])
        found = [best[i] + bits for i, bits in ending.pop(j, ())] + [x.cheapest(j, best) for x in around]
        best[j] = min([best[j - 1] + _alphabet(value[j - 1]), *(x + 1.0 for x in found)])  # a bit for the choice of segment
        dear = dear + 1 if best[j] >= enough else 0
        if dear > LONGEST and not any(x.end > j for x in around):
            return best[j]
    return best[n]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """What the fixed patterns find, by start and then kind."""
    spans = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [("hex", m.start(), m.end()) for m in _HEX_RUN.finditer(text)]
    return in_order(spans)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def guess_spans(text: str, base: list[tuple[str, int, int]], bits: float = GUESS_BITS, rank: dict[str, int] = _RANK) -> list[tuple[str, int, int]]:
    """Values after a credential's word that cost `bits` or more and lie in no base span."""
    found = []
    starts = [a for _, a, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))  # the furthest end of the base spans up to each
    for m in _CONTEXT.finditer(text):
        start, end = m.span(1)
        while end > start and text[end - 1] in ".,;:)]}>":
            end -= 1
        before = bisect_right(starts, start)
        if end - start >= 8 and not (before and reach[before - 1] >= end) and guess_bits(text[start:end], rank, bits) >= bits:
            found.append(("guess", start, end))
    return found


def find_spans(raw: bytes | None, bits: float = GUESS_BITS, rank: dict[str, int] = _RANK) -> tuple[list, list]:
    """(base spans, all spans) of a UTF-8 text; cheap searches for fixed bytes come first."""
    if not raw:
        return [], []
    low = raw.lower()
    context = any(k in low for k in _CONTEXT_WORDS)
    if not (context or b"AKIA" in raw or _HEX.search(raw)):
        return [], []
    text = raw.decode("utf-8", "replace")
    base = base_spans(text)
    return base, in_order(base + guess_spans(text, base, bits, rank)) if context else base


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_SCAN = "struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,spans:string>"


def _scan(rank: Broadcast):
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for texts in slices(batch):
                for raw in texts:
                    base, spans = find_spans(raw, rank=rank.value)
                    kinds = [k for k, _, _ in base]
                    rows.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()] * 2, strict=True)], ["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scan


def _redact(rank: Broadcast):
    def redact(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([without_secrets(raw, rank.value) for texts in slices(batch) for raw in texts], pa.string())

    return redact


def without_secrets(raw: bytes | None, rank: dict[str, int]) -> str | None:
    if raw is None:
        return None
    text, out, at = raw.decode("utf-8", "replace"), [], 0
    for start, end in merged([(a, b) for _, a, b in find_spans(raw, rank=rank)[1]]):
        out += [text[at:start], "[SECRET]"]
        at = end
    return "".join([*out, text[at:]])


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def with_secrets(docs: DataFrame, text: str = "text", out: str = "secrets", rank: dict[str, int] | None = None) -> DataFrame:
    """`docs` with a struct column `out`: counts of the base kinds, base_sha256, spans; rank: a lexicon other than that of `docs`."""
    known = docs.sparkSession.sparkContext.broadcast(learned_words(docs, text) if rank is None else rank)
    return docs.withColumn(out, F.arrow_udf(_scan(known), _SCAN)(F.col(text)))


def redacted(docs: DataFrame, text: str = "text", rank: dict[str, int] | None = None) -> DataFrame:
    """`docs` with every span of `text` replaced by [SECRET]; spans that overlap are replaced as one."""
    known = docs.sparkSession.sparkContext.broadcast(learned_words(docs, text) if rank is None else rank)
    return docs.withColumn(text, F.arrow_udf(_redact(known), "string")(F.col(text)))


def op4_secrets(spark, sf_dir: str) -> DataFrame:
    return with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets.*")
