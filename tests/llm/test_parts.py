"""Parts of the operators on their own."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import bpe, common, decontaminate, language, near_dups, quality, rules, secrets, substrings, toxicity, warc


def test_block_search_over_several_blocks(spark):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([1, 5, 11, 30])))) for i in range(30)]
    docs = [(d, " ".join(r.choices(vocabulary, k=50)) + " " + r.choice(items)[1]) for d in range(40)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = decontaminate.with_benchmark_hits(d, b).select("doc_id", "leak.n_words", "leak.n_hit", "leak.items").collect()
    many = decontaminate.with_benchmark_hits(d, b, block_chars=300).select("doc_id", "leak.n_words", "leak.n_hit", "leak.items").collect()
    assert sorted(one) == sorted(many)


def test_policies_and_ablation(spark):
    docs = spark.createDataFrame([(1, "few words"), (2, "tick " * 40), (3, "a | b | c | d | e | f | g | h | i | j"), (4, "x | y"), (5, " ".join(f"word{i}" for i in range(30)))], "doc_id int, text string")
    ledger = rules.with_ledger(docs)
    out = {r.doc_id: (r.kept_base_1, r.kept_strict_1) for r in rules.applied(ledger, [rules.POLICIES["base-1"], rules.POLICIES["strict-1"]]).collect()}
    assert out == {1: (False, False), 2: (False, False), 3: (True, False), 4: (False, False), 5: (True, True)}
    found = {r.rule: (r.failing, r.rejected, r.only_by_this) for r in rules.ablation(ledger, rules.POLICIES["strict-1"]).collect()}
    assert found["too_few_words"][:2] == (2, 4) and found["repeated_words"][2] == 1
    assert {r.rule for r in rules.ablation(ledger, rules.POLICIES["base-1"]).collect()} == {"too_few_words", "repeated_words"}


def test_long_repeated_text_is_fast(spark):
    docs = spark.createDataFrame([(1, "spam " * 200_000)], "doc_id int, text string")
    assert rules.with_ledger(docs).select("ledger.n_repeat_words").first()[0] == 200_000


def test_guess_costs():
    weak = ["password123", "Password2024!", "qwertyuiop12", "aaaaaaaaaaaaaaaa", "abcabcabcabcabc", "changeme", "p4ssw0rd", "19991231", "your-token-here"]
    strong = ["x8Kq!2vRz9#LmP", "4t7GhQz81LmNpR", "zK9vQ2mX7bT4"]
    assert max(map(secrets.guess_bits, weak)) < secrets.GUESS_BITS <= min(map(secrets.guess_bits, strong))
    assert secrets.guess_bits("ab" * 500) < 10 * secrets.GUESS_BITS and secrets.guess_bits("") == 0


def plain_bits(value):
    """The same costs by trying every segmentation."""
    segments = {}
    for i, j, bits in secrets._segments(value):
        segments[i, j] = min(bits + 1, segments.get((i, j), 1e9))

    def best(i):
        if i == len(value):
            return 0.0
        return min([secrets._alphabet(value[i]) + best(i + 1), *(bits + best(b) for (a, b), bits in segments.items() if a == i)])

    return best(0)


@pytest.mark.parametrize("value", ["pass1234", "redblue99", "qwe2024x", "aaabbb", "12121212", "Hello!Summer"])
def test_guess_costs_against_all_segmentations(value):
    assert secrets.guess_bits(value) == pytest.approx(plain_bits(value))


def test_context_values():
    assert [k for k, _, _ in secrets.find_spans(b"Bearer abcDEF123ghiJKL456")[1]] == ["guess"]
    assert secrets.find_spans(b"the password is required: password: required") == ([], [])
    text = 'é token="abcdefghijklmnop"'
    (kind, a, b) = secrets.find_spans(text.encode())[0][0]
    assert (kind, text[a:b]) == ("assign", 'token="abcdefghijklmnop')


def test_automaton_is_minimal_and_numbers_words():
    words = sorted({b"tap", b"taps", b"top", b"tops", b"stop", b"stops", b"a"})
    arrays = bpe.compile_automaton(words)
    arrays["moves"] = np.repeat(np.arange(len(arrays["final"])), np.diff(arrays["first"])) << 8 | arrays["label"]
    t = bpe.Transducer(arrays)
    assert t.places([*words, b"", b"to", b"tapss", b"z"]).tolist() == [*range(len(words)), -1, -1, -1, -1]
    suffixes = {frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(arrays["final"]) == len(suffixes)  # a state for each set of endings


def codec_of(words, folder):
    path = folder / "lexicon.bin"
    path.write_bytes(bpe.compiled(bpe.default_vocabulary(), words))
    return bpe.Codec(str(path))


@pytest.mark.parametrize("words", [[], [b" the", b"the", b"a" * 300, "Ⅰ中".encode(), b"'ll", b"zqxjk", b"  ", "\U0001f600".encode()]])
def test_codec_on_odd_texts(words, tmp_path):
    codec = codec_of(words, tmp_path)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    r = random.Random(9)
    letters = [chr(i) for i in range(0x250)] + list(" 　 ​́١\U0001f600中Ⅰ\xb2\xbd﻿") + ["<|endoftext|>", "  ", "'s", "'ll", "the"]
    texts = ["".join(r.choices(letters, k=r.randint(0, 60))) for _ in range(400)] + ["a" * 3000, "ab" * 2000, " " * 500]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert codec.decode([ids]) == [text]
    assert codec.decode(codec.encode(texts)) == texts and codec.decode([]) == []
    known = codec.transducer.ids(words)
    assert known == codec.merger.merge(words) and any(len(x) > 4 for x in known) == bool(words)


def test_ids_round_trip(spark):
    docs = spark.createDataFrame([(1, "Hello world"), (2, None), (3, "")], "doc_id int, text string")
    coded = bpe.with_ids(docs, bpe.default_vocabulary())
    assert [r.decoded for r in bpe.with_text(coded, bpe.default_vocabulary()).orderBy("doc_id").collect()] == ["Hello world", "", ""]


def test_long_lists_meet_in_the_middle(spark):
    r = random.Random(5)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    prints = set()
    for _ in range(15):
        base = r.getrandbits(64)
        for _ in range(r.choice([1, 2, 80])):
            x = base
            for _ in range(r.randint(0, 5)):
                x ^= 1 << r.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    root = list(range(len(prints)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[max(top(i), top(j))] = min(top(i), top(j))
    groups = {}
    for i, x in enumerate(prints):
        groups.setdefault(top(i), set()).add(signed(x))
    want = sorted(sorted(g) for g in groups.values() if len(g) > 1)
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long").repartition(5)
    for long_list in (near_dups.LONG_LIST, 4):
        found = {}
        for row in near_dups.roots_of(df, common.Shelf(spark, "test"), long_list).collect():
            found.setdefault(row.root, set()).add(row.fp)
        assert sorted(map(sorted, found.values())) == want


def test_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    out = dict(map(tuple, near_dups.connected(edges, common.Shelf(spark, "test")).collect()))
    assert {out[i] for i in range(61)} == {0} and out[101] == out[100] == 100


def test_equal_windows_go_by_equal_cores():
    r = random.Random(2)
    for size in (2, 3, 5, 40):
        vocabulary = [b"w%d" % i for i in range(size)]
        for _ in range(60):
            shared = r.choices(vocabulary, k=13)
            s = substrings.Stretch([b" ".join(r.choices(vocabulary, k=r.randint(0, 15)) + shared + r.choices(vocabulary, k=r.randint(0, 15))) for _ in range(3)] + [None, b"a", b"x " * 40])
            at, core, level, begin = s.owners()
            cores, seen = {p: (k, c) for p, k, c in zip(at.tolist(), core.tolist(), level.tolist(), strict=True)}, {}
            for b in begin.tolist():
                own = [(p - b, *cores[p]) for p in range(b + 4, b + 10) if p in cores]
                assert own
                own = [x for x in own if x[2] == max(y[2] for y in own)]
                seen.setdefault(tuple(s.name[b : b + 13].tolist()), set()).add(tuple(own))
            assert all(len(v) == 1 for v in seen.values())


def test_names_do_not_depend_on_blocks(monkeypatch):
    r = random.Random(4)
    texts = [b" ".join(b"w%d" % r.randrange(50) for _ in range(r.choice([0, 5, 200]))) for _ in range(30)] + [None, b"", b"\t\n", b"x" * 3000, "é ß\x1cz\x85 \u3000".encode()]
    whole = substrings.Stretch(texts)
    assert whole.words() == [w for t in texts for w in (t or b"").split()] and whole.size.tolist() == [len((t or b"").split()) for t in texts]
    names = whole.window_names()[1]
    monkeypatch.setattr(substrings, "_BLOCK", 64)
    parts = substrings.Stretch(texts)
    assert np.array_equal(parts.name, whole.name) and np.array_equal(parts.window_names()[1], names)
    by_name = {}
    for w, k in zip(whole.words(), whole.name.tolist(), strict=True):
        assert by_name.setdefault(k, w) == w


def test_repeats_are_removed_from_text(spark):
    words = [f"t{i}" for i in range(30)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "before  " + "\n".join(words[5:25]) + " after"), (3, None)], "doc_id long, text string")
    assert [r.text for r in substrings.without_repeats(docs).orderBy("doc_id").collect()] == [" ".join(words), "before after", None]


def test_ranges_are_coalesced():
    spans = [(0, 10), (10, 5), (100, 5), (100_000, 5)]
    assert warc.ranges(spans, gap=50, most=1000) == [(0, 15, [0, 1]), (100, 105, [2]), (100_000, 100_005, [3])]
    assert warc.ranges(spans, gap=10**6, most=50)[0] == (0, 15, [0, 1])


def test_archives_roll_and_selected_records_are_read(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i % 40}</p>" * 50) for i in range(100)], "page_id long, url string, html string").coalesce(1)
    folder = common.fresh_folder(spark, "test-warc")
    index, _ = warc.write_archives(pages, folder, roll_bytes=2000)
    assert index.select("archive").distinct().count() > 3
    some = warc.read_records(index.where("page_id % 10 = 3 and record_type = 'response'")).collect()
    assert {(r.page_id, r.payload.decode()) for r in some} == {(i, f"<p>{i % 40}</p>" * 50) for i in range(60, 100) if i % 10 == 3}
    assert index.where("record_type = 'revisit'").count() == 60


def test_damage_is_noticed():
    member = bytearray(warc.gzipped(warc.record(1, "u", b"payload", None)))
    assert warc.parsed(bytes(member))["payload"] == b"payload"
    raw = warc.record(1, "u", b"payload", None).replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n")
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(warc.gzipped(raw))


def test_pairs_of_terms_are_learned():
    """Neither word alone is toxic; both together are."""
    r = random.Random(1)
    texts, labels = [], []
    for _ in range(1500):
        words = r.choices([f"w{i}" for i in range(30)], k=8)
        a, b = r.random() < 0.5, r.random() < 0.5
        texts.append(" ".join(words + ["insult"] * a + ["group"] * b))
        labels.append(float(a and b))
    machine = toxicity.fit([np.array(toxicity.terms(t.encode())) for t in texts], np.array(labels), float(np.mean(labels)))
    scores = machine.logits([toxicity.terms(t) for t in (b"insult group w1", b"insult w1", b"group w1", b"w1", b"")])
    assert (scores > 0).tolist() == [True, False, False, False, False]


def test_held_out_toxicity_and_quality():
    r = random.Random(4)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ter", "sun") for b in ("ra", "ne", "tol", "vi")]
    good = [" ".join(r.choices(plain, k=60)).encode() for _ in range(150)]
    bad = [" | ".join([r.choice(plain)] * 50).encode() for _ in range(150)]
    labels = np.array([1.0] * 100 + [0.0] * 100, np.float32)
    net = quality.fit(good[:100] + bad[:100], labels, 0.5)
    assert (net.logits(good[100:]) > 0).mean() > 0.95 and (net.logits(bad[100:]) < 0).mean() > 0.95
    assert quality.probability(net.logits([None, b""])).shape == (2,)


def test_chunks_cover_texts():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        c = quality.chunks(bytes(range(256)) * 20 if n == 5000 else b"a" * n)
        size = 5120 if n == 5000 else n
        assert len(c) == quality.chunk_count(size) and (c != quality.PAD).sum() >= size


def test_long_text_in_pieces_has_the_same_vector(monkeypatch):
    code = language.Encoder(64)
    text = ("the quick brown fox " * 500).encode()
    whole = code.vectors([text, b"other", None])
    monkeypatch.setattr(language, "PIECE", 100)
    assert np.array_equal(code.vectors([text, b"other", None]), whole)


def test_language_profiles(spark):
    r = random.Random(8)
    speak = lambda parts: " ".join("".join(r.choices(parts, k=3)) for _ in range(30))
    rows = [(i, speak(["the", "ing", "er", "and"]) if i % 2 else speak(["eau", "que", "les", "é"]), "en" if i % 2 else "fr") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, own = language.learn_prototypes(docs.where("doc_id < 40"))
    out = language.with_language(docs.where("doc_id >= 40"), names, own).select("lang", "language.lang_pred").collect()
    assert names == ["en", "fr"] and sum(r.lang == r.lang_pred for r in out) == len(out)


def test_slices_keep_order_and_nulls():
    import pyarrow as pa

    texts = ["a" * 10, None, "", "b" * 100, "c"]
    parts = list(common.slices(pa.array(["zz", *texts]).slice(1), 12))
    assert [t for p in parts for t in p] == [None if t is None else t.encode() for t in texts] and len(parts) > 1


def test_bounded_sample(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2 == 0).cast("int").alias("label"))
    sizes = dict(map(tuple, common.bounded_sample(rows, "label", 300, common.stratum_sizes(rows, "label")).groupBy("label").count().collect()))
    assert all(200 < n < 400 for n in sizes.values())
    assert common.bounded_sample(rows, "label", 10_000, {0: 2500, 1: 2500}).count() == 5000


def test_commonest_words_fit_the_bound(spark):
    rows = [(b"a", 100), (b"b", 90), *[(b"c%d" % i, 40) for i in range(10)], (b"d", 3), (b"e", 1)]
    counts = spark.createDataFrame(rows, "word binary, n bigint")
    assert [w for w, _ in common.frequent(counts, 100, 2)] == [b"a", b"b", *(b"c%d" % i for i in range(10)), b"d"]
    assert [w for w, _ in common.frequent(counts, 5, 2)] == [b"a", b"b"] and common.frequent(counts.limit(0), 5, 2) == []
    assert common.frequent(counts.where("n = 40"), 5, 2) == []


def test_words_are_counted_over_all_texts(spark):
    docs = spark.createDataFrame([("x y x",), (None,), ("",), ("y zz é",)] * 50, "text string").repartition(7)
    found = common.word_counts(docs, lambda t: (t or b"").split(), lambda w: len(w) < 3).collect()
    assert {bytes(r.word): r.n for r in found} == {b"x": 100, b"y": 100, b"zz": 50, "é".encode(): 50}
