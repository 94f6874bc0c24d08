"""Name normalisation as Column functions.

Folding to ASCII is a map of single characters: a table from `unicodedata` gives `translate` its two sides for
characters that fold to one, and of those that fold to several the ones that a text has are replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens of legal forms, dropped wherever they stand.
LEGAL_SUFFIXES = ["llc", "inc", "corp", "corporation", "ltd", "lp", "llp", "pllc", "pc", "co"]

# Words that say little about which business is meant.
STOPWORDS = [
    "the", "and", "group", "services", "service", "solutions", "solution", "enterprise", "enterprises", "company", "consulting",
    "consultants", "counseling", "entertainment", "technology", "technologies", "logistics", "medical", "health", "wellness",
    "transport", "transportation", "courier", "couriers", "investment", "investments", "capital", "holdings", "ventures",
    "properties", "property", "management", "financial", "finance", "partners", "industries", "international",
]

# Tokens written short.
SHORTHAND = {"4": "for", "u": "you", "&": "and", "+": "and"}

# What divides a legal name from a trading name.
TRADING_MARKS = ["dba", "doing business as"]

_PUNCTUATION = "".join(c for c in map(chr, range(0x80)) if not (c.isalnum() or c in "_&+ \t\n\x0b\f\r"))
_INITIALS_THERE = r"\b[a-z]\.[a-z]\."
_SHORT_THERE = r"(?:^|\s)[4u&+](?:\s|$)"
_INITIALS = r"(?<=\b[a-z])\.(?:(?=[a-z]\.)|(?<=\b[a-z]\.[a-z]\.))"


@lru_cache(maxsize=1)
def fold_table() -> tuple[str, str, dict[str, str]]:
    """(characters, what each folds to, those that fold to several): compatibility decomposition without what is beyond ASCII."""
    one, to, several = [], [], {}
    for point in range(0x80, 0x2FA20):
        if 0xD800 <= point < 0xE000:
            continue
        folded = unicodedata.normalize("NFKD", chr(point)).encode("ascii", "ignore").decode()
        if len(folded) == 1:
            one.append(chr(point))
            to.append(folded)
        elif len(folded) > 1:
            several[chr(point)] = folded
    return "".join(one), "".join(to), several


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """`of(value)` with `value` worked out once."""
    return F.transform(F.array(value), of)[0]


def constants(pairs: dict[str, str]) -> Column:
    """A map as one literal that the optimizer folds, rather than a Column for each entry."""
    return F.str_to_map(F.lit("\x1e".join(f"{k}\x1f{v}" for k, v in pairs.items())), F.lit("\x1e"), F.lit("\x1f"))


def character_class(characters: list[str]) -> str:
    """A pattern's class of these characters."""
    ranges: list[list[int]] = []
    for point in sorted(map(ord, characters)):
        if ranges and point == ranges[-1][1] + 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


def ascii_fold(x: Column) -> Column:
    """Only texts with a character beyond ASCII pay for the table, and characters that fold to several are looked for only among those that it leaves beyond ASCII."""
    one, to, several = fold_table()
    beyond = "[^\\x00-\\x7F]"
    wide = f"({character_class(list(several))})"
    found = lambda s: F.array_distinct(F.regexp_extract_all(F.regexp_replace(s, "[\\x00-\\x7F]+", ""), F.lit(wide), F.lit(1)))
    spelled = lambda s: F.aggregate(found(s), s, lambda out, c: F.replace(out, c, F.try_element_at(constants(several), c)))
    rest = lambda s: F.when(s.rlike(beyond), F.regexp_replace(spelled(s), beyond + "+", "")).otherwise(s)
    return let(x, lambda s: F.when(s.rlike(beyond), let(F.translate(s, one, to), rest)).otherwise(s))


def strip_notes(x: Column) -> Column:
    return F.when(F.contains(x, F.lit("(")), F.regexp_replace(x, r"\([^)]*\)", " ")).otherwise(x)


def squeeze(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def tokens(x: Column) -> Column:
    """Words between white space; none for an empty text."""
    return F.filter(F.split(x, r"\s+"), lambda t: t != "")


def expand_shorthand(x: Column) -> Column:
    """Words joined by single spaces, those written short in full."""
    pairs = constants(SHORTHAND)
    return F.array_join(F.transform(tokens(x), lambda t: F.coalesce(F.try_element_at(pairs, t), t)), " ")


def collapse_initials(x: Column) -> Column:
    """`l.l.c.` to `llc`; on lower-case text."""
    return F.when(x.rlike(_INITIALS_THERE), F.regexp_replace(x, _INITIALS, "")).otherwise(x)


def normalize(x: Column) -> Column:
    """Steps that few texts need are tried only where a cheaper test finds what they look for.

    A folded text is ASCII, so that what is neither word, space nor & or + is a fixed set; each of it becomes a space.
    """
    low = F.lower(ascii_fold(F.coalesce(x, F.lit(""))))
    bare = F.translate(let(let(low, strip_notes), collapse_initials), _PUNCTUATION, " " * len(_PUNCTUATION))
    spelled = lambda s: F.when(s.rlike(_SHORT_THERE), expand_shorthand(s)).otherwise(s)
    return squeeze(let(bare, spelled))


def without(x: Column, words: list[str]) -> Column:
    listed = F.split(F.lit(" ".join(words)), " ")
    return F.array_join(F.filter(tokens(x), lambda t: ~F.array_contains(listed, t)), " ")


def strip_legal_suffixes(x: Column) -> Column:
    return without(normalize(x), LEGAL_SUFFIXES)


def remove_stopwords(x: Column) -> Column:
    return without(x, STOPWORDS)


def core(x: Column) -> Column:
    """Without legal forms and stopwords."""
    return remove_stopwords(strip_legal_suffixes(x))


def significant_tokens(x: Column) -> Column:
    return F.array_distinct(tokens(core(x)))


def split_trading_names(x: Column) -> Column:
    """The text without notes, and the parts on either side of each trading mark."""

    def parts(text: Column) -> Column:
        found = [F.array(text)]
        for mark in TRADING_MARKS:
            sides = F.split(text, rf"(?i)\b{mark}\b", 2)
            trimmed = F.transform(sides, lambda s: F.regexp_replace(s, r"^[ ,\-/]+|[ ,\-/]+$", ""))
            found.append(F.when(F.size(sides) > 1, trimmed).otherwise(F.array().cast("array<string>")))
        return F.filter(F.concat(*found), lambda s: s != "")

    return let(strip_notes(F.coalesce(x, F.lit(""))), parts)


def name_variants(*values: Column) -> Column:
    """Distinct variants in order: for each value and part: normalised, without legal forms, without stopwords too."""

    def of_part(part: Column) -> Column:
        return let(normalize(part), lambda n: let(without(n, LEGAL_SUFFIXES), lambda s: F.array(n, s, remove_stopwords(s))))

    def of_value(v: Column) -> Column:
        known = v.isNotNull() & (F.lower(F.trim(v)) != "nan")
        return F.when(known, F.flatten(F.transform(split_trading_names(v), of_part))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.filter(F.flatten(F.transform(F.array(*values), of_value)), lambda s: s != ""))


def first_variant(variants: Column) -> Column:
    return F.coalesce(F.get(variants, F.lit(0)), F.lit(""))


def is_identifier(x: Column) -> Column:
    return normalize(x).rlike("^[a-z]?[0-9]{3,}$")


def stable_hash(*parts: Column) -> Column:
    return F.sha1(F.concat_ws("||", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))


def join_name(*parts: Column) -> Column:
    return F.concat_ws(" ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def size_band(raw: Column) -> Column:
    """struct<low, high> of a text such as "$10,000 - $50,000" or "100k+"; nulls if it has no number."""

    def band(text: Column) -> Column:
        pattern = r"(\d+(?:\.\d+)?)\s*([kKmM]?)"
        scale = lambda u: F.when(F.lower(u) == "k", 1e3).when(F.lower(u) == "m", 1e6).otherwise(1.0)
        values = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), lambda n, u: n.cast("double") * scale(u))

        def ends(v: Column) -> Column:
            high = F.when((F.size(v) == 1) & F.contains(text, F.lit("+")), F.lit(float("inf"))).otherwise(F.array_max(v))
            return F.struct(F.array_min(v).alias("low"), F.when(F.size(v) > 0, high).alias("high"))

        return let(values, ends)

    return let(F.replace(F.coalesce(raw, F.lit("")), F.lit(","), F.lit("")), band)


# Credential shapes in errors and what stands for them, in the order in which they are replaced; the length kept.
CREDENTIALS = [
    (r"sk-ant-[A-Za-z0-9_\-]+", "[redacted-api-key]"),
    (r"(?i)Bearer\s+[A-Za-z0-9._\-]+", "Bearer [redacted]"),
    (r"""(?i)(x-api-key['"=:\s]+)[A-Za-z0-9._\-]+""", "$1[redacted]"),
]
SCRUBBED_CHARS = 600


def scrub(x: Column) -> Column:
    """Credential shapes redacted, at most `SCRUBBED_CHARS` characters."""
    for shape, shown in CREDENTIALS:
        x = F.regexp_replace(x, shape, shown)
    return F.substring(x, 1, SCRUBBED_CHARS)


def rounded(x: Column, digits: int) -> Column:
    """`x` to so many decimals by its exact binary value, a half to the even side, as Python's round does.

    With k the floor of the scaled number, the doubled scaled number is compared with 2k + 1, where the product is
    taken exactly: as its nearest double and the rest, from the halves of x's digits.
    """
    scale = float(10**digits)
    twice = 2 * scale

    def nearest(v: Column) -> Column:
        k = F.floor(v * scale)
        high = v * 134217729.0 - (v * 134217729.0 - v)
        product = v * twice
        rest = (high * twice - product) + (v - high) * twice
        beyond = (product - (k * 2 + 1)) + rest
        return (k + F.when((beyond > 0) | ((beyond == 0) & (k % 2 != 0)), 1).otherwise(0)).cast("double") / scale

    return F.when(x.isNotNull(), let(x.cast("double"), nearest))


def round2(x: Column) -> Column:
    return rounded(x, 2)
