"""Learned scorers against plain loops over the same parameters, and columns whose names clash with internal ones."""

import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkloom.llm import bpe, decontaminate, language, near_dups, quality, rules, secrets, substrings, toxicity

TEXTS = [None, b"", b" \n", "été ß Ωмир".encode(), b"one two three", b"Insult group, insult GROUP!", b"a" * 700, b" ".join(b"w%d" % (i % 37) for i in range(900)), b"x | y | z " * 100]


def trained(module):
    r = random.Random(3)
    texts = [" ".join(r.choices([f"w{i}" for i in range(40)] + ["insult", "group", "|"], k=r.randint(1, 150))).encode() for _ in range(120)] + TEXTS
    labels = np.array([float(b"insult" in (t or b"")) for t in texts], np.float32)
    if module is quality:
        return quality.fit(texts, labels, 0.3, epochs=2)
    return toxicity.fit([np.array(sorted(toxicity.terms(t)), np.int64) for t in texts], labels.astype(float), 0.3)


def test_network_against_loops():
    net = trained(quality)

    def plain(text):
        text = text or b""
        starts, pooled = [0], []
        while starts[-1] + quality.CHUNK < len(text):
            starts.append(starts[-1] + quality.CHUNK - quality.OVERLAP)
        for s in starts:
            chunk = [*text[s : s + quality.CHUNK]]
            chunk += [quality.PAD] * (quality.CHUNK - len(chunk))
            best = [0.0] * quality.FILTERS
            for at in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE):
                seen = np.concatenate([net.embed[b] for b in chunk[at : at + quality.WIDTH]]).astype(float)
                for f in range(quality.FILTERS):
                    best[f] = max(best[f], float(seen @ net.filters[:, f]) + float(net.shift[f]))
            pooled.append(best)
        mean, most = [sum(x) / len(pooled) for x in zip(*pooled, strict=True)], [max(x) for x in zip(*pooled, strict=True)]
        return float(np.dot([*mean, *most], net.out)) + net.bias

    assert net.logits(TEXTS) == pytest.approx([plain(t) for t in TEXTS], abs=1e-3)


def test_gradients_against_differences():
    r = np.random.default_rng(5)
    p = {"embed": r.normal(0, 0.5, (quality.PAD + 1, quality.EMBED)), "filters": r.normal(0, 0.15, (quality.WIDTH * quality.EMBED, quality.FILTERS)), "shift": r.normal(0, 0.1, quality.FILTERS), "out": r.normal(0, 0.3, 2 * quality.FILTERS), "bias": np.zeros(1)}
    samples, labels = [quality.chunks(t) for t in (b"some words here " * 80, b"other | things " * 3)], np.array([1.0, 0.0])

    def loss(p):
        own = [quality.Network(p["embed"], p["filters"], p["shift"], p["out"], float(p["bias"][0])).pooled(c)[0] for c in samples]
        x = np.array([np.concatenate([o.mean(axis=0), o.max(axis=0)]) @ p["out"] + p["bias"][0] for o in own])
        return float(np.mean(np.log1p(np.exp(x)) - labels * x)) + 0.5e-4 * float(p["out"] @ p["out"])

    g = quality.gradients(p, samples, labels)
    for name, at in [("bias", (0,)), ("out", (3,)), ("out", (40,)), ("shift", (5,)), ("filters", (9, 7)), ("embed", (ord("o"), 2))]:
        up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert g[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=2e-2, abs=1e-5), name


def test_fitting_reads_every_chunk():
    """The label is told by the last words of long texts only."""
    r = random.Random(1)
    filler = [f"{a}{b}" for a in ("ka", "lo", "mi", "ter") for b in ("ra", "ne", "tol", "vi")]
    texts, labels = [], []
    for i in range(160):
        words = r.choices(filler, k=2600)
        words[r.randint(1200, 2500) :] += ["QQQQQQ"] * 12 if i % 2 else []
        texts.append(" ".join(words).encode())
        labels.append(float(i % 2))
    assert min(quality.chunk_count(len(t)) for t in texts) > 20
    net = quality.fit(texts[:120], np.array(labels[:120], np.float32), 0.5, epochs=12)
    assert np.mean((net.logits(texts[120:]) > 0) == np.array(labels[120:], bool)) > 0.9


def test_machine_against_loops():
    machine = trained(toxicity)

    def plain(text):
        own = [machine.place[h] for h in toxicity.terms(text) if machine.place[h] >= 0]
        pairs = sum(float(machine.factor[a] @ machine.factor[b]) for a, b in combinations(own, 2))
        return machine.bias + sum(float(machine.weight[a]) for a in own) + pairs

    assert machine.logits([toxicity.terms(t) for t in TEXTS]) == pytest.approx([plain(t) for t in TEXTS], abs=1e-6)


def test_profiles_against_loops():
    code = language.Encoder(64)

    def plain(text):
        symbols, total = [0], np.zeros(64)
        for c in (text or b"").decode("utf-8", "replace"):
            low = ord(c.lower()[0])
            s = (low if low < language.OWN else language.OWN + (low * 2654435761 >> 7) % language.OWN) if c.isalpha() else 0
            if s or symbols[-1]:
                symbols.append(s)
        if symbols[-1]:
            symbols.append(0)
        for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False):
            letter = code.letters.astype(float)
            total += np.roll(letter[a], 2) * np.roll(letter[b], 1) * letter[c]
        return total

    assert np.array_equal(code.vectors(TEXTS), np.array([plain(t) for t in TEXTS], np.float32))
    assert len({code.symbol[ord(c)] for c in "abzéßΩяאبकก"}) == 11


def test_language_scores_against_loops(spark):
    r = random.Random(8)
    speak = lambda parts: " ".join("".join(r.choices(parts, k=3)) for _ in range(30))
    rows = [(i, speak(["the", "ing", "er"]) if i % 2 else speak(["eau", "que", "é"]), "en" if i % 2 else "fr") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, own = language.learn_prototypes(docs)
    code = language.encoder(language.DIMENSIONS)
    want = {name: sum(v / math.sqrt(float(v @ v)) for v in code.vectors([t.encode() for _, t, x in rows if x == name]).astype(float)) for name in names}
    for r in language.with_language(docs, names, own).collect():
        v = code.vectors([r.text.encode()])[0].astype(float)
        cosines = {n: float(v @ p) / math.sqrt(float(v @ v) * float(p @ p)) for n, p in want.items()}
        assert r.language.lang_pred == max(cosines, key=cosines.get) and r.language.score == pytest.approx(max(cosines.values()), abs=1e-4)


CLASHING = [
    "words", "lines", "n_words", "fails", "word_chars", "own_digest", "stays", "its_digest", "nth", "id", "digest", "fp", "root", "first", "least", "component_id", "its_id", "its_mark", "passages",
    "copied", "both", "amiss", "mark", "keys", "name", "at", "c", "k", "c0", "c1", "a", "b", "label", "x", "wanted", "parts", "low", "word", "n", "item_id", "toxicity", "secrets", "bpe", "leak", "ledger", "language", "quality_score",
]


@pytest.fixture(scope="module")
def clashing(spark):
    item = " ".join(f"item{i}" for i in range(12))
    rows = [(i, " ".join(f"w{j * (i % 4 + 1)}" for j in range(40)) + (f" {item}" if i == 3 else "") + (" password = Zk3vQ9xT7wLm2pRa" if i == 1 else "")) for i in range(6)] + [(None, None), (6, ""), (7, "short")]
    return spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", *[F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHING])


def kept_values(rows, but=()):
    for r in rows.collect():
        tail = "none" if r.doc_id is None else str(r.doc_id)
        assert all(r[c] == f"{c}-{tail}" for c in CLASHING if c not in but)
    return rows


def test_clashing_columns_stay(spark, clashing):
    benchmark = spark.createDataFrame([(1, " ".join(f"item{i}" for i in range(12)))], "item_id int, text string")
    n = clashing.count()
    assert kept_values(rules.with_ledger(clashing), ["ledger"]).columns == clashing.columns
    assert kept_values(decontaminate.with_benchmark_hits(clashing, benchmark), ["leak"]).count() == n
    assert kept_values(decontaminate.clean_documents(clashing, benchmark)).columns == clashing.columns
    assert kept_values(near_dups.one_of_each(clashing)).columns == clashing.columns
    without = kept_values(substrings.without_repeats(clashing))
    assert without.columns == clashing.columns and without.count() == n
    assert kept_values(secrets.redacted(clashing)).count() == n and kept_values(secrets.with_secrets(clashing), ["secrets"]).count() == n
    assert kept_values(bpe.with_ids(clashing, bpe.default_vocabulary(), out="ids")).count() == n
    assert kept_values(quality.with_quality(clashing, trained(quality)), ["quality_score"]).count() == n
    assert kept_values(toxicity.with_toxicity(clashing, trained(toxicity)), ["toxicity"]).count() == n
    assert kept_values(language.with_language(clashing, ["en"], np.ones((1, 512), np.float32)), ["language"]).count() == n


def test_stages_keep_clashing_columns(spark, clashing, folder):
    docs = clashing
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = kept_values(stage(spark, docs, folder))
        assert docs.columns == clashing.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_string_ids(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 6, "0")).alias("doc_id"), "text")
    plain = {(r.doc_id, r.component_id) for r in near_dups.components(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    found = {(r.doc_id, r.component_id) for r in near_dups.components(docs).collect()}
    name = lambda d: None if d is None else f"d{d:06d}"
    assert found == {(name(a), name(b)) for a, b in plain}
