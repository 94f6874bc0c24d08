"""Every registered query against a brute-force version over the tricky tables, and over empty ones."""

import base64
import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from linkloom.llm import bpe, registry, secrets, substrings

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def split(text):
    return [w for w in SPACE.split(text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def results(spark, folder):
    made = {}

    def get(name):
        if name not in made:
            made[name] = [r.asDict() for r in registry.queries()[name](spark, folder).collect()]
        return made[name]

    return get


def same(rows, want, columns):
    key = lambda x: repr(x)
    assert sorted((tuple(r[c] for c in columns) for r in rows), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("name", [*registry.OPERATORS, "pipeline"])
def test_empty_tables(spark, empty_folder, name):
    assert registry.queries()[name](spark, empty_folder).collect() == []


def test_rules(results, corpus):
    want = []
    for doc_id, text, *_ in corpus[0]:
        t, w = text or "", split(text)
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        repeat = {p for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
        lines = [x for x in t.split("\n") if split(x)]
        symbols = sum(c in "#*$%&|<>" for c in t)
        want.append((doc_id, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeat), len(w) < 10 or 100 * len(repeat) > 20 * len(w)))
    same(results("op1_quality_rules"), want, ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"])
    assert all(not r["kept"] for r in results("op1_quality_rules") if r["base_failed"])


def benchmark_hits(corpus):
    """For each document: id, text, words, hit words and items, by trying every window at every place."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for item, text in corpus[1]:
        w = low(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    for doc_id, text, *_ in corpus[0]:
        w, hit, items = low(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (k := tuple(w[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    items |= windows[k]
        yield doc_id, text, len(w), hit, items


def test_decontamination(results, corpus):
    want = []
    for doc_id, _, n, hit, items in benchmark_hits(corpus):
        ids = sorted(str(x) for x in items if x is not None)
        want.append((doc_id, n, len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    same(results("op2_decontaminate"), want, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    assert sum(x[-1] for x in want) >= 4


def remainder(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def test_language(results, corpus):
    texts = {(d, t) for d, t, *_ in corpus[0]}
    rows = results("op3_language")
    same(rows, [(d, remainder(d, 4) == 2) for d, *_ in corpus[0]], ["doc_id", "held_out"])
    und = {d for d, t in texts if not any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == und and all(0 <= r["score"] <= 1 for r in rows)


def test_secrets(results, corpus):
    assign = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    want = []
    for doc_id, text, *_ in corpus[0]:
        t = text or ""
        spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m[1]) >= 12]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        kinds = Counter(s[2] for s in spans)
        want.append((doc_id, kinds["assign"], kinds["access"], kinds["hex"], sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)))))
    same(results("op4_secrets"), want, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"])
    assert sum(x[1] for x in want) and sum(x[2] for x in want) and sum(x[3] for x in want)
    assert any("guess:" in r["spans"] for r in results("op4_secrets"))


@pytest.mark.parametrize(("name", "divisor", "rest"), [("op5_toxicity", 5, 0), ("op7_quality", 3, 1)])
def test_scores(results, corpus, name, divisor, rest):
    rows = results(name)
    same(rows, [(d, remainder(d, divisor) == rest) for d, *_ in corpus[0]], ["doc_id", "held_out"])
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_bpe(results, corpus):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    library.no_truncation()
    library.no_padding()
    want = []
    for doc_id, text, *_ in corpus[0]:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), sha(library.decode(ids, skip_special_tokens=False))))
    same(results("op6_bpe"), want, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def fingerprint(text):
    w = split(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [w] if 0 < len(w) < 4 else [w[i : i + 4] for i in range(len(w) - 3)]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def parts(prints):
    root = list(range(len(prints)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(prints))]


def test_simhash(results, corpus):
    ids = [d for d, *_ in corpus[0]]
    prints = [fingerprint(t) for _, t, *_ in corpus[0]]
    root = parts(prints)
    least = defaultdict(list)
    for d, p in zip(ids, root, strict=True):
        if d is not None:
            least[p].append(d)
    want = [(d, f"{p:016x}", min(least[k], default=None)) for d, p, k in zip(ids, prints, root, strict=True)]
    same(results("op8_simhash"), want, ["doc_id", "fingerprint", "component_id"])


def repeats(rows):
    """doc_id, words, words removed and digest of what is kept, by every window of every text."""
    first = {}
    for d, t in rows:
        w = split(t)
        if d is not None:
            for i in range(len(w) - 12):
                k = tuple(w[i : i + 13])
                first[k] = min(first.get(k, d), d)
    for d, t in rows:
        w = split(t)
        gone = {p for i in range(len(w) - 12) if d is not None and first[tuple(w[i : i + 13])] < d for p in range(i, i + 13)}
        yield d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))


REPEATS = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def test_substrings(results, corpus):
    want = list(repeats([(d, t) for d, t, *_ in corpus[0]]))
    same(results("op9_substrings"), want, REPEATS)
    assert sum(x[2] for x in want) > 200


def repetitive(r):
    """Texts of few words, so that names clash, windows recur and ids have several texts."""
    vocabulary = [f"w{i}" for i in range(6)]
    passage = r.choices(vocabulary, k=40)
    for i in range(120):
        own = r.choices(vocabulary, k=r.randint(0, 60))
        at = r.randint(0, len(own))
        some = passage[r.randint(0, 10) : r.randint(20, 40)] if i % 3 else r.choice(vocabulary) * 1 and [r.choice(vocabulary)] * r.randint(5, 40)
        yield (None if i == 50 else r.choice([i, i, 7, 30])), None if i == 60 else " ".join(own[:at] + some + own[at:])


@pytest.mark.parametrize("bits", [64, 9])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_substrings_when_names_clash(spark, tmp_path, bits, kind):
    """Names of nine bits have most windows share theirs with others: words decide."""
    r = random.Random(bits)
    rows = [(None if d is None else f"{d:05d}" if kind == "string" else d, t) for d, t in repetitive(r)]
    spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = [x.asDict() for x in substrings.op9_substrings(spark, str(tmp_path), bits).collect()]
    same(found, list(repeats(rows)), REPEATS)
    assert sum(x["n_removed"] for x in found) > 200


def test_warc(results, corpus):
    payload = lambda h: (h or "").encode()
    last = defaultdict(list)
    for p, _, h in corpus[3]:
        if p is not None:
            last[payload(h)].append(p)
    want = []
    for p, _, h in corpus[3]:
        b = payload(h)
        m = max(last[b], default=None)
        response = m is None or p == m
        want.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if response else "revisit", None if response else m))
    same(results("op10_warc"), want, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def test_pipeline(spark, folder, results):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        assert docs.count() <= before.count()
    texts = [r.text or "" for r in docs.select("text").collect()]
    assert not any("04dbebab91ab" in t or "AKIAABC" in t for t in texts)
    assert len(results("pipeline")) == len(texts)
    assert sorted(r["decoded_sha256"] for r in results("pipeline")) == sorted(map(sha, texts))


def test_pipeline_against_brute_force(spark, folder, corpus, results):
    """From what the learned first stage keeps, every later stage is done again by plain means."""
    import corpus_pipeline

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_toxic(spark, docs, folder).collect()]
    root = parts([fingerprint(t) for _, t in kept])
    leaky = {(d, t) for d, t, _, hit, _ in benchmark_hits(corpus) if hit}
    least = defaultdict(list)
    for (d, _), p in zip(kept, root, strict=True):
        if d is not None:
            least[p].append(d)
    stays = {min(ids) for ids in least.values()}
    clean = [(d, t) for d, t in {x for x in kept if x[0] in stays} - leaky]
    counts = Counter(w for _, t in clean for w in secrets.words_of(None if t is None else t.encode()) if secrets.may_be_listed(w))
    rank = secrets.ranked([w.decode() for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])) if n >= secrets.LEAST_COUNT])
    want = []
    for d, t in clean:
        raw = None if t is None else t.encode()
        for a, b in reversed(secrets.merged([(a, b) for _, a, b in secrets.find_spans(raw, rank=rank)[1]])):
            t = f"{t[:a]}[SECRET]{t[b:]}"
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()))
    same(results("pipeline"), want, ["doc_id", "n_tokens", "ids_sha256"])


def test_redaction_merges_overlaps(spark):
    rows = spark.createDataFrame([(1, 'a token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" b'), (2, None), (3, "clean")], "doc_id long, text string")
    assert [r.text for r in secrets.redacted(rows).orderBy("doc_id").collect()] == ['a [SECRET]" b', None, "clean"]
