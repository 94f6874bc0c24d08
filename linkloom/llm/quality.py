"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover it whole. Each byte has a learned vector, and
learned filters read eight bytes at every fourth place; each filter keeps its greatest value in a chunk. A
text's mean and greatest values over its chunks are combined into one probability.

The network is fitted on the driver on a bounded sample: `PER_CLASS` labelled texts of each class are
expected (see labelled_sample), each with all its chunks. The last bias is corrected for the classes' shares
among all labelled texts. Scoring reads whole texts. Chunks are worked on `BLOCK` at a time, so that memory does
not grow with the length of a text, in fitting or in scoring.

Edge cases: an empty or null text is one chunk of padding; a long text has as many chunks as it needs; without
labels of both classes every score is the share of label 1 among the labels (0 without any); an empty table
gives no rows; repeated rows are scored alike, and count once in the sample. `with_quality` replaces a column
that has the name of its result, as withColumn does; all other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import labelled_sample, remainder, slices, table

CHUNK, OVERLAP = 512, 64
WIDTH, EMBED, FILTERS = 8, 8, 32
STRIDE = WIDTH // 2
PAD = 256
PER_CLASS = 2500
#: Chunks worked on at a time.
BLOCK = 512
EPOCHS = 8


def chunk_count(size: int) -> int:
    return 1 if size <= CHUNK else 1 + -(-(size - CHUNK) // (CHUNK - OVERLAP))


def chunks(text: bytes | None) -> np.ndarray:
    """(chunks, CHUNK) byte values; the last chunk is padded."""
    raw = np.frombuffer(text or b"", np.uint8)
    n = chunk_count(len(raw))
    padded = np.full(CHUNK + (n - 1) * (CHUNK - OVERLAP), PAD, np.int16)
    padded[: len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[:: CHUNK - OVERLAP]


@dataclass
class Network:
    embed: np.ndarray  # (PAD + 1, EMBED)
    filters: np.ndarray  # (WIDTH * EMBED, FILTERS)
    shift: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (2 * FILTERS,)
    bias: float

    def _pooled_block(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        groups = self.embed[c.reshape(-1)].reshape(-1, STRIDE * EMBED)
        half = STRIDE * EMBED
        first = (groups @ self.filters[:half]).reshape(len(c), -1, self.filters.shape[1])
        second = (groups @ self.filters[half:]).reshape(first.shape)
        value = first[:, :-1]
        value += second[:, 1:]
        at = value.argmax(axis=1)
        return np.maximum(np.take_along_axis(value, at[:, None], 1)[:, 0] + self.shift, 0), at

    def pooled(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest value of each filter in each chunk, at least 0, and its place."""
        blocks = [self._pooled_block(c[at : at + BLOCK]) for at in range(0, len(c), BLOCK)]
        return np.concatenate([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks])

    def logits(self, texts: list[bytes | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        parts, held, own, sizes = [], 0, [], []
        for t in texts:
            c = chunks(t)
            sizes.append(len(c))
            for at in range(0, len(c), BLOCK):
                parts.append(c[at : at + BLOCK])
                held += len(parts[-1])
                if held >= BLOCK:
                    own.append(self.pooled(np.concatenate(parts))[0])
                    parts, held = [], 0
        if parts:
            own.append(self.pooled(np.concatenate(parts))[0])
        own, starts = np.concatenate(own), np.cumsum([0, *sizes[:-1]])
        features = np.concatenate([np.add.reduceat(own, starts) / np.array(sizes)[:, None], np.maximum.reduceat(own, starts)], axis=1)
        return features @ self.out + self.bias


def probability(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(texts: list[bytes | None], labels: np.ndarray, prior: float, epochs: int = EPOCHS) -> Network:
    """Adam on the logistic loss, over all chunks of each text; prior: the share of label 1 that the bias is corrected to."""
    rng = np.random.default_rng(11)
    p = {
        "embed": rng.normal(0, 0.5, (PAD + 1, EMBED)).astype(np.float32),
        "filters": rng.normal(0, 0.15, (WIDTH * EMBED, FILTERS)).astype(np.float32),
        "shift": np.zeros(FILTERS, np.float32),
        "out": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        "bias": np.zeros(1, np.float32),
    }
    p["embed"][PAD] = 0
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    share = labels.mean() if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Network(p["embed"], p["filters"], p["shift"], 0 * p["out"], float(np.log(prior / (1 - prior))))
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // 64)):
            step += 1
            for k, g in gradients(p, [chunks(texts[i]) for i in batch], labels[batch]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g**2
                p[k] = (p[k] - 0.004 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Network(p["embed"], p["filters"], p["shift"], p["out"], float(p["bias"][0] + np.log(prior / (1 - prior)) - np.log(share / (1 - share))))


def gradients(p: dict[str, np.ndarray], samples: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean logistic loss over a batch; samples: the chunks of each text."""
    c, sizes = np.concatenate(samples), np.array([len(x) for x in samples])
    starts, text = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(samples)), sizes)
    own, at = Network(p["embed"], p["filters"], p["shift"], p["out"], 0.0).pooled(c)
    mean, most = np.add.reduceat(own, starts) / sizes[:, None], np.maximum.reduceat(own, starts)
    features = np.concatenate([mean, most], axis=1)
    error = ((probability(features @ p["out"] + p["bias"]) - labels) / len(samples)).astype(np.float32)
    d_mean, d_most = error[:, None] * p["out"][:FILTERS], error[:, None] * p["out"][FILTERS:]
    place = np.where(own == most[text], np.arange(len(c))[:, None], len(c))
    top = place == np.minimum.reduceat(place, starts)[text]  # the first chunk with the greatest value
    d = ((d_mean[text] / sizes[text, None] + d_most[text] * top) * (own > 0)).astype(np.float32)
    g = {"out": features.T @ error + 1e-4 * p["out"], "bias": error.sum(keepdims=True), "shift": d.sum(axis=0)}
    g |= {"filters": np.zeros_like(p["filters"]), "embed": np.zeros_like(p["embed"])}
    for a in range(0, len(c), BLOCK):
        b = slice(a, a + BLOCK)
        spot = c[b][np.arange(len(c[b]))[:, None, None], at[b][:, :, None] * STRIDE + np.arange(WIDTH)]  # (chunks, filters, WIDTH)
        seen = p["embed"][spot].reshape(len(spot), FILTERS, -1)
        g["filters"] += np.einsum("cf,cfw->wf", d[b], seen, optimize=True)
        back = (d[b][:, :, None] * p["filters"].T[None]).reshape(-1, EMBED)
        g["embed"] += np.stack([np.bincount(spot.reshape(-1), back[:, k], PAD + 1) for k in range(EMBED)], axis=1).astype(np.float32)
    g["embed"][PAD] = 0
    return g


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Network:
    """A network from the documents that `labels` (doc_id, label 0 or 1; other rows are left out) covers."""
    sample, sizes = labelled_sample(docs, labels, label, per_class, lambda text: text.cast("binary"))
    n = sum(sizes.values())
    return fit([t.as_py() for t in sample["x"]], sample["label"].to_numpy().astype(np.float32), sizes.get(1, 0) / n if n else 0.0)


def with_quality(docs: DataFrame, network: Network, text: str = "text", out: str = "quality_score") -> DataFrame:
    """`docs` with a column `out`: the probability of label 1."""
    known = docs.sparkSession.sparkContext.broadcast(network)  # of fixed size

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            logits = [known.value.logits(texts) for texts in slices(batch)]
            yield pa.array(probability(np.concatenate([[], *logits])), pa.float64())

    return docs.withColumn(out, F.arrow_udf(score, "double")(F.col(text)))


def held_out_quality(doc_id: Column) -> Column:
    return remainder(doc_id, 3) == 1


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out_quality(F.col("doc_id")))
    scored = with_quality(docs, learn(docs, labels))
    return scored.select("doc_id", held_out_quality(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
