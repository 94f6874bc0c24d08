"""Language ID by hyperdimensional profiles.

Each letter has a random vector of +1 and -1; a trigram's vector is the product of its letters' vectors, the
first permuted twice and the second once, so that order counts; a text's vector is the sum of its trigrams'
vectors. A language's prototype is the sum of the vectors, scaled to length one, of its learned texts, and a
text gets the language whose prototype has the greatest cosine with its own vector.

Letters are lower-cased; what is no letter separates words and counts as one mark, so that a trigram can show
how words begin and end. Letters below `OWN` have a vector of their own, those above one of as many by a hash
of their code point.

Prototypes are learned from a bounded sample, `per_language` texts for each language (see bounded_sample);
the partial sums of at most `LEARNERS` tasks go to the driver, one vector for each language and task.

Edge cases: a null text, or one without a letter, is `und` with score 0; without any learned language so is
every text; the score is the cosine, at least 0; ties go to the first language in order of its name; a long
text is taken in pieces, whole; repeated rows are scored alike; an empty table gives no rows. `with_language`
replaces a column that has the name of its result, as withColumn does; all other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import bounded_sample, remainder, slices, stratum_sizes, table

DIMENSIONS = 512
#: Letters below this code point have a vector each; as many vectors are shared by the others.
OWN = 4096
SYMBOLS, SHIFT = 2 * OWN, 13
PER_LANGUAGE = 2000
LEARNERS = 8
#: Code points handled at a time within one text.
PIECE = 1 << 20


def _symbols() -> np.ndarray:
    """Symbol of each code point: 0 for what is no letter."""
    symbol = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            low = ord(chr(c).lower()[0])
            symbol[c] = low if low < OWN else OWN + (low * 2654435761 >> 7) % OWN
    return symbol


class Encoder:
    """Vectors of trigrams and texts."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.symbol = _symbols()
        self.letters = np.where(np.random.default_rng(20240229).random((SYMBOLS, dimensions)) < 0.5, -1, 1).astype(np.int8)
        self.once, self.twice = np.roll(self.letters, 1, axis=1), np.roll(self.letters, 2, axis=1)

    def trigram_vectors(self, trigrams: np.ndarray) -> np.ndarray:
        a, b, c = trigrams >> 2 * SHIFT, (trigrams >> SHIFT) & (SYMBOLS - 1), trigrams & (SYMBOLS - 1)
        return (self.twice[a] * self.once[b] * self.letters[c]).astype(np.float32)

    def trigrams(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, trigram, count) over all texts, each row and trigram once."""
        rows, grams, counts = [], [], []
        keys: list[np.ndarray] = []
        held = 0

        def reduce() -> None:
            nonlocal keys, held
            if keys:
                k, n = np.unique(np.concatenate(keys), return_counts=True)
                rows.append(k >> 3 * SHIFT)
                grams.append(k & ((1 << 3 * SHIFT) - 1))
                counts.append(n)
            keys, held = [], 0

        for row, text in enumerate(texts):
            points = np.frombuffer((text or b"").decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
            s = np.concatenate([[0], self.symbol[points], [0]]).astype(np.int64)
            s = s[np.concatenate([[True], (s[1:] > 0) | (s[:-1] > 0)])]  # one mark between words
            for at in range(0, max(len(s) - 2, 0), PIECE):
                p = s[at : at + PIECE + 2]
                keys.append(row << 3 * SHIFT | p[:-2] << 2 * SHIFT | p[1:-1] << SHIFT | p[2:])
                held += len(p)
                if held >= PIECE:
                    reduce()
        reduce()
        if not rows:
            return (np.empty(0, np.int64),) * 3
        return np.concatenate(rows), np.concatenate(grams), np.concatenate(counts)

    def vectors(self, texts: list[bytes | None]) -> np.ndarray:
        """A row for each text: the sum of its trigrams' vectors."""
        rows, grams, counts = self.trigrams(texts)
        out = np.zeros((len(texts), self.dimensions), np.float32)
        if not len(rows):
            return out
        key = grams << 24 | rows  # a slice has fewer rows than that
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) > 0]))  # pieces of a long text repeat its trigrams
        counts, rows, grams = np.add.reduceat(counts[order], first), rows[order][first], grams[order][first]
        distinct, column = np.unique(grams, return_inverse=True)
        for at in range(0, len(distinct), 4096):  # blocks of trigrams bound the memory
            own = slice(*np.searchsorted(column, [at, at + 4096]))
            many = np.zeros((len(texts), min(4096, len(distinct) - at)), np.float32)
            many[rows[own], column[own] - at] = counts[own]
            out += many @ self.trigram_vectors(distinct[at : at + 4096])
        return out


_ENCODERS: dict[int, Encoder] = {}


def encoder(dimensions: int) -> Encoder:
    if dimensions not in _ENCODERS:
        _ENCODERS[dimensions] = Encoder(dimensions)
    return _ENCODERS[dimensions]


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-9)


def learn_prototypes(labelled: DataFrame, per_language: int = PER_LANGUAGE, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """(languages in order, their prototypes as rows) from columns doc_id, text, lang."""
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sample = bounded_sample(usable, "lang", per_language, stratum_sizes(usable, "lang")).repartition(LEARNERS, F.xxhash64("doc_id"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, total = encoder(dimensions), {}
        for batch in batches:
            langs, at = batch.column("lang").to_pylist(), 0
            for texts in slices(batch.column("text")):
                for lang, v in zip(langs[at : at + len(texts)], unit(code.vectors(texts)), strict=True):
                    total[lang] = total.get(lang, 0) + v.astype(np.float64)
                at += len(texts)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(total), pa.string()), "v": pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))})

    total: dict[str, np.ndarray] = {}
    for lang, v in sorted(map(tuple, sample.mapInArrow(sums, "lang string, v array<double>").collect())):
        total[lang] = total.get(lang, 0) + np.array(v)
    languages = sorted(total)
    return languages, unit(np.array([total[x] for x in languages])).astype(np.float32) if languages else np.zeros((0, dimensions), np.float32)


def with_language(docs: DataFrame, languages: list[str], prototypes: np.ndarray, text: str = "text", out: str = "language") -> DataFrame:
    """`docs` with a struct column `out`: lang_pred and score."""
    known = docs.sparkSession.sparkContext.broadcast((languages, prototypes))  # one row for each language

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, own = known.value
        code = encoder(own.shape[1])
        for batch in batches:
            preds, scores = [], []
            for texts in slices(batch, 1 << 20):
                v = code.vectors(texts)
                cosine = unit(v) @ own.T if len(names) else np.zeros((len(texts), 1), np.float32)
                some = np.abs(v).sum(axis=1) > 0
                best = cosine.argmax(axis=1)
                preds += [names[b] if s and names else "und" for b, s in zip(best, some, strict=True)]
                scores.append(np.where(some & bool(names), np.clip(cosine.max(axis=1), 0, 1), 0.0).astype(np.float64))
            yield pa.StructArray.from_arrays([pa.array(preds, pa.string()), pa.array(np.concatenate([[], *scores]))], ["lang_pred", "score"])

    return docs.withColumn(out, F.arrow_udf(predict, "struct<lang_pred:string,score:double>")(F.col(text)))


def held_out_languages(doc_id: Column) -> Column:
    return remainder(doc_id, 4) == 2


def op3_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    known = learn_prototypes(docs.where(~held_out_languages(F.col("doc_id"))))
    return with_language(docs.select("doc_id", "text"), *known).select("doc_id", held_out_languages(F.col("doc_id")).alias("held_out"), "language.*")
