"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words (letters and digits; A-Z in lower case) and the first `PREFIX` bytes of
longer words, hashed to `BITS` bits. Its
logit is a bias, a weight for each term, and for each pair of terms the product of their factor vectors, so
that an insult can weigh more beside a mention of a group than either does alone.

The machine is fitted on the driver on a bounded sample: `PER_CLASS` labelled texts of each class are
expected (see labelled_sample), whose hashed terms are gathered. A term weighs something if it is in `LEAST_TEXTS`
of them and its association with the label is `LEAST_Z` or more, or if it is in `LEAST_PAIRED` and, among the texts
that have some other term, its association with the label is beyond chance (see in_pairs). The bias is corrected for the
classes' shares among all labelled texts. Scoring reads whole texts.

Edge cases: an empty or null text has no term, so that its score is that of the bias; a long text is read
whole; without labels of both classes every score is the share of label 1 among the labels (0 without any); an
empty table gives no rows; repeated rows are scored alike, and count once in the sample. `with_toxicity`
replaces a column that has the name of its result, as withColumn does; all other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import labelled_sample, remainder, slices, table

BITS = 18
PREFIX = 4
FACTORS = 6
PER_CLASS = 5000
LEAST_TEXTS = 3
LEAST_Z = 5.0
LEAST_PAIRED = 10
LEAST_TOGETHER = 4
#: The chance that any pair at all seems associated where none is.
PAIR_CHANCE = 0.01
#: Texts whose pairs are counted at a time.
TOGETHER = 512
EPOCHS = 40
BATCH = 64
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_MASK = (1 << BITS) - 1


def terms(text: bytes | None) -> list[int]:
    """Hashes of the distinct words and of the longer words' beginnings."""
    words = set((text or b"").translate(_FOLD).split())
    words.update({b"^" + w[:PREFIX] for w in words if len(w) > PREFIX})
    return list({crc32(w) & _MASK for w in words})


@dataclass
class Machine:
    """bias, and for each selected hash a row of weights and factors; place: row of a hash, -1 for the others."""

    bias: float
    place: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def logits(self, hashes: list[list[int]]) -> np.ndarray:
        sizes = np.array([len(h) for h in hashes], np.int64)
        flat = self.place[np.fromiter((x for h in hashes for x in h), np.int64, int(sizes.sum()))]
        text = np.repeat(np.arange(len(hashes)), sizes)[flat >= 0]
        return self.bias + linear_and_pairs(text, flat[flat >= 0], len(hashes), self.weight, self.factor)[0]


def linear_and_pairs(text: np.ndarray, row: np.ndarray, n: int, weight: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sum of weights and of factor products over pairs, and its sum of factors."""
    total = np.zeros((n, factor.shape[1]))
    np.add.at(total, text, factor[row])
    square = np.bincount(text, (factor[row] ** 2).sum(axis=1), n)
    return np.bincount(text, weight[row], n) + 0.5 * ((total**2).sum(axis=1) - square), total


def counted(hashes: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many texts have each term, and how many of them have label 1; a text's terms are distinct."""
    all_, ones = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for h, y in zip(hashes, labels.astype(int).tolist(), strict=True):
        all_[h] += 1
        ones[h] += y
    return all_, ones


def in_pairs(hashes: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The terms of pairs that say more about the label than either of the two does alone.

    Let a share q of the texts with one term have label 1, and of the m texts with both a share r. A share so far
    from q comes about with a chance under exp(-m * KL(r, q)) (Chernoff's bound), and both terms are taken if that
    is under `PAIR_CHANCE` over the number of pairs for the q of either; with under `LEAST_TOGETHER` texts it hardly can be. Pairs are counted term by term, and
    for `TOGETHER` texts at a time, so that memory is that of two small integers for each term of each text.
    """
    all_, with_one = counted(hashes, labels)
    known = np.flatnonzero(all_ >= LEAST_PAIRED)
    place, v = np.full(1 << BITS, -1, np.int32), len(known)
    place[known] = np.arange(v)
    starts = np.cumsum([0, *(np.count_nonzero(place[h] >= 0) for h in hashes)])
    coded = np.empty(starts[-1], np.int32)  # the terms of all texts, text by text; v more where the label is 1
    ends = np.cumsum(all_[known])
    order, free = np.empty(starts[-1], np.min_scalar_type(starts[-1])), ends - all_[known]  # order: each term's spots in coded
    for h, y, a, b in zip(hashes, labels.astype(int).tolist(), starts.tolist(), starts[1:].tolist(), strict=False):
        own = np.sort(place[h][place[h] >= 0])
        coded[a:b] = own + np.int32(v * y)
        order[free[own]] = np.arange(a, b)
        free[own] += 1
    bound, taken = 2 * np.log(max(v, 2)) - np.log(PAIR_CHANCE), np.zeros(v, bool)
    alone = np.clip(with_one[known] / all_[known], 1e-9, 1 - 1e-9)
    log_one, log_zero = np.log(alone), np.log(1 - alone)
    for s in range(v):
        spots = order[ends[s - 1] if s else 0 : ends[s]].astype(np.int64)
        until = starts[np.searchsorted(starts, spots, "right")].tolist()
        after = [coded[a:b] for a, b in zip((spots + 1).tolist(), until, strict=True)]  # each pair once
        zeros, ones = sum(np.bincount(np.concatenate(after[k : k + TOGETHER]), minlength=2 * v) for k in range(0, len(after), TOGETHER)).reshape(2, v)
        often = np.flatnonzero(zeros + ones >= LEAST_TOGETHER)
        zeros, ones = zeros[often], ones[often]
        m = zeros + ones
        plain = ones * np.log(np.maximum(ones, 1) / m) + zeros * np.log(np.maximum(zeros, 1) / m)
        far = plain - np.maximum(ones * log_one[s] + zeros * log_zero[s], ones * log_one[often] + zeros * log_zero[often]) > bound
        taken[often[far]] = True
        taken[s] |= bool(far.any())
    return known[taken]


def fit(hashes: list[np.ndarray], labels: np.ndarray, prior: float, factors: int = FACTORS, epochs: int = EPOCHS) -> Machine:
    """Adaptive gradient steps on the logistic loss; prior: the share of label 1 that the bias is corrected to."""
    n_one, n = int(labels.sum()), len(labels)
    place = np.full(1 << BITS, -1, np.int32)
    if n_one in (0, n):
        p = min(max(prior, 1e-6), 1 - 1e-6)
        return Machine(float(np.log(p / (1 - p))), place, np.zeros(0), np.zeros((0, factors)))
    all_, ones = counted(hashes, labels)
    expected = all_ * (n_one / n)
    z = (ones - expected) / np.sqrt(np.maximum(expected * (1 - n_one / n) * (1 - all_ / n), 1e-9))
    alone = np.flatnonzero((all_ >= LEAST_TEXTS) & (np.abs(z) >= LEAST_Z))
    chosen = np.union1d(alone, in_pairs(hashes, labels))
    place[chosen] = np.arange(len(chosen))
    rng = np.random.default_rng(7)
    weight, factor, bias = np.zeros(len(chosen)), rng.normal(0, 0.05, (len(chosen), factors)), float(np.log(n_one / (n - n_one)))
    gw, gf, gb = np.full(len(chosen), 1e-2), np.full((len(chosen), factors), 1e-2), 1e-2
    kept = [place[h][place[h] >= 0] for h in hashes]
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(n), max(1, n // BATCH)):
            rows = [kept[i] for i in batch]
            text, row = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)
            value, total = linear_and_pairs(text, row, len(rows), weight, factor)
            error = (1 / (1 + np.exp(-np.clip(bias + value, -30, 30))) - labels[batch]) / len(batch)
            dw, df = np.zeros_like(weight), np.zeros_like(factor)
            np.add.at(dw, row, error[text])
            np.add.at(df, row, error[text, None] * (total[text] - factor[row]))
            dw += 1e-4 * weight
            df += 1e-3 * factor
            db = error.sum()
            gw, gf, gb = gw + dw**2, gf + df**2, gb + db**2
            weight -= 0.2 * dw / np.sqrt(gw)
            factor -= 0.05 * df / np.sqrt(gf)
            bias -= 0.1 * db / np.sqrt(gb)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    return Machine(float(bias + np.log(prior / (1 - prior)) - np.log(n_one / (n - n_one))), place, weight, factor)


def _hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([terms(t) for texts in slices(batch) for t in texts], pa.list_(pa.int32()))


def in_order(lists: pa.ChunkedArray) -> list[np.ndarray]:
    """The hashes of each text in order: views of one array, made without an object for each hash."""
    sizes = lists.combine_chunks().value_lengths().to_numpy()
    flat, ends = np.concatenate([np.zeros(0, np.int32), *(c.flatten().to_numpy() for c in lists.chunks)]), np.cumsum(sizes)
    views = [flat[b - n : b] for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
    for view in views:
        view.sort()
    return views


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Machine:
    """A machine from the documents that `labels` (doc_id, label 0 or 1; other rows are left out) covers."""
    sample, sizes = labelled_sample(docs, labels, label, per_class, lambda text: F.arrow_udf(_hashed, "array<int>")(text))
    hashes, classes, n = in_order(sample["x"]), sample["label"].to_numpy().astype(float), sum(sizes.values())
    del sample
    return fit(hashes, classes, sizes.get(1, 0) / n if n else 0.0)


def with_toxicity(docs: DataFrame, machine: Machine, text: str = "text", out: str = "toxicity") -> DataFrame:
    """`docs` with a column `out`: the probability of label 1."""
    known = docs.sparkSession.sparkContext.broadcast(machine)  # at most 2^BITS rows

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            logits = [known.value.logits([terms(t) for t in texts]) for texts in slices(batch)]
            yield pa.array(1 / (1 + np.exp(-np.clip(np.concatenate([[], *logits]), -30, 30))), pa.float64())

    return docs.withColumn(out, F.arrow_udf(score, "double")(F.col(text)))


def held_out_toxicity(doc_id: Column) -> Column:
    return remainder(doc_id, 5) == 0


def learned_from(spark, docs: DataFrame, sf_dir: str) -> Machine:
    return learn(docs, table(spark, sf_dir, "labels").where(~held_out_toxicity(F.col("doc_id"))))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_toxicity(docs, learned_from(spark, docs, sf_dir))
    return scored.select("doc_id", held_out_toxicity(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
