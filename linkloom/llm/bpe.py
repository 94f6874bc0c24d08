"""BPE encoding and decoding with a minimal acyclic transducer as the lexicon.

Spark counts the words (pre-tokens) of all texts. The `LEXICON_WORDS` commonest that occur `LEAST_COUNT` times or
more are merged once and compiled into a minimal acyclic automaton that shares prefixes and suffixes; the
numbers on the transitions of a word's path add up to its place among the words in byte order, and a table
turns that place into its ids, one or several. The compiled arrays, those of the merges and those of decoding
are one file, which Spark ships to the executors from the shared folder; each worker maps it into its memory
and reads the arrays there. Each distinct word of a slice of texts walks the automaton, all of them at once.
Words that the automaton lacks are merged exactly: all pairs of all unseen words of a slice are ranked at once,
and each word merges its first pair of least rank until none is left.

Texts are split as the vocabulary file's byte-level pre-tokenizer does; the strings of special tokens are
taken as these tokens, as the tokenizers library does by default. No tokenizer is trained here; the
vocabulary file's path is a parameter.

Edge cases: a null text is empty; an empty text has no ids (the digest of no bytes); texts are encoded whole,
however long; ids that the vocabulary lacks can't be decoded and raise an error; an empty table has no words,
an automaton that accepts none, and no rows; repeated rows get the same result. The functions replace a column
that has the name of their result, as withColumn does; all other columns stay.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import frequent, fresh_folder, put_bytes, slices, table, word_counts

#: Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for texts whose word characters are letters, decimal digits and underscores only.
_PLAIN = re.compile(r"""'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""")
_FULL = regex.compile(PATTERN)
#: Letters and digits of which the two are known to agree; other characters beyond ASCII take the full pattern.
_ODD = re.compile("[^\x00-\x1b\x20-\x7f¡-±´-¸º»¿-ɏ‐-‧‰-⁞₠-₿]")
LEXICON_WORDS = 100_000
LEAST_COUNT = 2
#: Words of the lexicon that the driver merges at a time.
MERGED = 10_000


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary file."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, bytes and merges of a vocabulary file."""

    def __init__(self, spec: dict):
        byte = byte_characters()
        spell = lambda token: bytes(byte[c] for c in token)
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes: list[bytes | None] = [None] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.bytes[i] = token.encode() if token in self.special else spell(token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.of_byte = np.array([ids[c] for c, b in sorted(byte.items(), key=lambda x: x[1])], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left, self.right, self.made = (np.array(x, np.int64) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in pairs), strict=True))


class Merger:
    """Exact merges of many words at a time."""

    NONE = np.int64(1 << 40)

    def __init__(self, of_byte: np.ndarray, made: np.ndarray, keys: np.ndarray, ranks: np.ndarray):
        self.of_byte, self.made, self.keys, self.ranks = of_byte, made, keys, ranks
        self.bits = len(keys).bit_length() - 1

    @classmethod
    def of(cls, vocabulary: Vocabulary) -> Merger:
        """With a hash table of the ranks of all pairs (open addressing)."""
        pairs = vocabulary.left << 24 | vocabulary.right
        size = 1 << int(np.ceil(np.log2(len(pairs) * 4)))
        merger = cls(vocabulary.of_byte, vocabulary.made, np.full(size, -1, np.int64), np.full(size, cls.NONE, np.int64))
        slot, rest = merger._slot(pairs), np.arange(len(pairs))
        while len(rest):  # those that find their slot free take it, the others move on
            free = merger.keys[slot[rest]] == -1
            first = np.unique(slot[rest[free]], return_index=True)[1]
            put = rest[free][first]
            merger.keys[slot[put]], merger.ranks[slot[put]] = pairs[put], put
            rest = np.setdiff1d(rest, put)
            slot[rest] = (slot[rest] + 1) & (size - 1)
        return merger

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 24 | right
        slot = self._slot(keys)
        ranks = np.where(self.keys[slot] == keys, self.ranks[slot], self.NONE)
        look = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        while len(look):
            slot[look] = (slot[look] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[look]]
            ranks[look[there == keys[look]]] = self.ranks[slot[look[there == keys[look]]]]
            look = look[(there != keys[look]) & (there != -1)]
        return ranks

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word (none of them empty), as little-endian unsigned 32-bit integers."""
        out: list = [None] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= 64]
        for i, w in enumerate(words):
            if len(w) > 64:
                out[i] = self._long(w)
        if not short:
            return out
        ids = self.of_byte[np.frombuffer(b"".join(words[i] for i in short), np.uint8)]
        word = np.repeat(np.arange(len(short)), [len(words[i]) for i in short])
        rank = np.full(len(ids), self.NONE)
        same = np.flatnonzero(word[1:] == word[:-1])
        rank[same] = self.rank(ids[same], ids[same + 1])
        done_ids, done_word = [], []
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(ids)))
            over = np.repeat(best == self.NONE, sizes)
            if over.any():
                done_ids.append(ids[over])
                done_word.append(word[over])
                ids, word, rank, best, sizes = ids[~over], word[~over], rank[~over], best[best != self.NONE], sizes[best != self.NONE]
                if not len(ids):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            hits = hits[np.concatenate([[True], word[hits][1:] != word[hits][:-1]])]  # the first in each word
            ids[hits] = self.made[rank[hits]]
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            at = (np.cumsum(keep) - 1)[hits]
            ids, word, rank = ids[keep], word[keep], rank[keep]
            for near in (at - 1, at):  # only the pairs on either side of a merge have new ranks
                near = near[(near >= 0)]
                inside = near[(near + 1 < len(ids))]
                rank[near] = self.NONE
                inside = inside[word[inside] == word[inside + 1]]
                rank[inside] = self.rank(ids[inside], ids[inside + 1])
        ids, word = np.concatenate(done_ids), np.concatenate(done_word)
        flat = ids[np.argsort(word, kind="stable")].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(word, minlength=len(short)))).tolist()
        for i, a, b in zip(short, [0, *ends], ends, strict=False):
            out[i] = flat[a:b]
        return out

    def _long(self, word: bytes) -> bytes:
        """One long word, by a heap of its pairs."""
        import heapq

        ids = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        ranks = self.rank(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        none = int(self.NONE)
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r < none]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[r]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else -1
                if y >= 0 and (new := self._one(ids[x], ids[y])) < none:
                    heapq.heappush(heap, (new, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def _one(self, a: int, b: int) -> int:
        key, size = a << 24 | b, (1 << self.bits) - 1
        slot = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - self.bits)
        while self.keys[slot] not in (key, -1):
            slot = (slot + 1) & size
        return int(self.ranks[slot]) if self.keys[slot] == key else int(self.NONE)


def compile_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """Arrays of the minimal acyclic automaton of `words` (distinct, in byte order).

    first[s]: place of state s's transitions; label, target and skip of each transition; skip is how many
    words stand before those that take it; final[s]: 1 if a word ends there.
    """
    known: dict[tuple, int] = {}  # a finished state by what it accepts
    states: list[tuple] = []

    def finish(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in known:
            known[key] = len(states)
            states.append(key)
        return known[key]

    path: list[list] = [[0, []]]  # final, [(label, state)]
    previous = b""
    for w in [*words, b""]:
        common = 0
        while common < min(len(w), len(previous)) and w[common] == previous[common]:
            common += 1
        for depth in range(len(previous), common, -1):
            done = finish(path.pop())
            path[-1][1].append((previous[depth - 1], done))
        for _ in w[common:]:
            path.append([0, []])
        if w:
            path[-1][0] = 1
        previous = w
    root = finish(path[0])
    count = [0] * len(states)  # words below a state; targets are finished before their sources
    first, label, target, skip = [0], [], [], []
    for s, (final, moves) in enumerate(states):
        below = final
        for c, t in moves:
            label.append(c)
            target.append(t)
            skip.append(below)
            below += count[t]
        count[s] = below
        first.append(len(label))
    return {"first": np.array(first, np.int32), "label": np.array(label, np.uint8), "target": np.array(target, np.int32), "skip": np.array(skip, np.int32), "final": np.array([f for f, _ in states], np.uint8), "root": np.array([root], np.int32)}


class Transducer:
    """Walks the automaton for many words at a time; reads its arrays where they are."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.a = arrays

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word among those of the automaton, -1 where it doesn't accept it."""
        size = np.array([len(w) for w in words], np.int64)
        text = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        state = np.full(len(words), self.a["root"][0], np.int64)
        place = np.zeros(len(words), np.int64)
        moves = self.a["moves"]
        alive = np.flatnonzero(size > 0) if len(moves) else np.empty(0, np.int64)
        result = np.full(len(words), -1, np.int64)
        depth = 0
        while len(alive):
            key = state[alive] << 8 | text[start[alive] + depth]
            at = np.minimum(np.searchsorted(moves, key), len(moves) - 1)
            ok = moves[at] == key
            alive, at = alive[ok], at[ok]
            place[alive] += self.a["skip"][at]
            state[alive] = self.a["target"][at]
            depth += 1
            ended = size[alive] == depth
            over = alive[ended]
            over = over[self.a["final"][state[over]] == 1]
            result[over] = place[over]
            alive = alive[~ended]
        return result

    def ids(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word as little-endian unsigned 32-bit integers, None where the automaton doesn't accept it."""
        place = self.places(words)
        ends, ids = self.a["ends"], self.a["ids"].view(np.uint8)
        low, high = (4 * ends[place]).tolist(), (4 * ends[place + 1]).tolist()
        return [ids[a:b].tobytes() if p >= 0 else None for p, a, b in zip(place.tolist(), low, high, strict=True)]


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> tuple[Vocabulary, Merger]:
    with open(path, encoding="utf-8") as f:
        vocabulary = Vocabulary(json.load(f))
    return vocabulary, Merger.of(vocabulary)


def compiled(vocabulary_path: str, words: list[bytes]) -> bytes:
    """A vocabulary file and a lexicon of distinct words as the bytes of a file for `Codec`."""
    vocabulary, merger = _vocabulary(vocabulary_path)
    words = sorted(words)
    arrays = compile_automaton(words)
    coded = [c for k in range(0, len(words), MERGED) for c in merger.merge(words[k : k + MERGED])]
    arrays |= {"moves": np.repeat(np.arange(len(arrays["final"]), dtype=np.int64), np.diff(arrays["first"])) << 8 | arrays["label"]}
    arrays |= {"ids": np.frombuffer(b"".join(coded), "<u4"), "ends": np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int64)}
    spelled = [b or b"" for b in vocabulary.bytes]
    arrays |= {"of_byte": merger.of_byte, "made": merger.made, "keys": merger.keys, "ranks": merger.ranks}
    arrays |= {"spelled": np.frombuffer(b"".join(spelled), np.uint8), "spelled_ends": np.cumsum([0, *map(len, spelled)], dtype=np.int64)}
    head, body, at = {}, [], 0
    for name, x in arrays.items():
        raw = x.tobytes()
        raw += b"\0" * (-len(raw) % 8)
        head[name] = (at, len(x), x.dtype.str)
        body.append(raw)
        at += len(raw)
    top = json.dumps({"arrays": head, "special": vocabulary.special}).encode()
    top += b" " * (-(len(top) + 8) % 8)
    return struct.pack("<q", len(top)) + top + b"".join(body)


class Splitter:
    """Cuts texts into pre-tokens, with the strings of special tokens among them."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def words(self, text: str) -> list[str]:
        find = (_FULL if _ODD.search(text) else _PLAIN).findall
        if self.at_special and any(s in text for s in self.special):
            return [w for part in self.at_special.split(text) for w in ([part] if part in self.special else find(part))]
        return find(text)


def _decoded(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


class Codec:
    """Encodes and decodes with a compiled file, which it maps into memory."""

    def __init__(self, path: str):
        mapped = np.memmap(path, np.uint8, "r")
        size = struct.unpack("<q", mapped[:8].tobytes())[0]
        head = json.loads(mapped[8 : 8 + size].tobytes())
        body = mapped[8 + size :]
        self.a = a = {k: np.frombuffer(body, np.dtype(kind), n, at) for k, (at, n, kind) in head["arrays"].items()}
        self.special = {w: struct.pack("<I", i) for w, i in head["special"].items()}
        self.split = Splitter(head["special"]).words
        self.transducer = Transducer(a)
        self.merger = Merger(a["of_byte"], a["made"], a["keys"], a["ranks"])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(t) for t in texts]
        words = list(set().union(*split) - self.special.keys())
        raw = [w.encode("utf-8", "replace") for w in words]
        ids = self.transducer.ids(raw)
        unseen = [k for k, x in enumerate(ids) if x is None]
        for k, x in zip(unseen, self.merger.merge([raw[k] for k in unseen]), strict=True):
            ids[k] = x
        look = dict(zip(words, ids, strict=True), **self.special).__getitem__
        return [b"".join(map(look, own)) for own in split]

    def decode(self, coded: list[bytes]) -> list[str]:
        """The texts that ids stand for."""
        ids, ends = np.frombuffer(b"".join(coded), "<u4").astype(np.int64), self.a["spelled_ends"]
        if len(ids) and ids.max() >= len(ends) - 1:
            raise ValueError(f"no token has the id {ids.max()}")
        size = ends[ids + 1] - ends[ids]
        after = np.cumsum(size)
        raw = self.a["spelled"][np.repeat(ends[ids] - (after - size), size) + np.arange(after[-1] if len(ids) else 0)].tobytes()
        cuts = np.concatenate([[0], after])[np.cumsum([0, *(len(c) // 4 for c in coded)])].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    return Codec(path)


def frequent_words(docs: DataFrame, vocabulary_path: str, text: str = "text", most: int = LEXICON_WORDS, least: int = LEAST_COUNT) -> list[bytes]:
    """The commonest words of all texts of `docs`; special tokens aside."""
    special = _vocabulary(vocabulary_path)[0].special

    splitter = Splitter(special)

    def words(raw: bytes | None) -> list[str]:
        return splitter.words(_decoded(raw))

    return [w for w, _ in frequent(word_counts(docs, words, lambda w: w not in special, text), most, least)]


_SHIPPED: dict[tuple, str] = {}


def _shipped(spark, vocabulary_path: str, words: list[bytes]) -> str:
    """The name under which the compiled file is sent to the executors; the same file is sent once for each application."""
    key = (spark.sparkContext.applicationId, vocabulary_path, hashlib.sha256(repr(words).encode()).hexdigest())
    if key not in _SHIPPED:
        folder = fresh_folder(spark, "lexicon")
        name = folder.rpartition("/")[2] + ".bin"
        put_bytes(spark, f"{folder}/{name}", compiled(vocabulary_path, words))
        spark.sparkContext.addFile(f"{folder}/{name}")
        _SHIPPED[key] = name
    return _SHIPPED[key]


def _lexicon(docs: DataFrame, vocabulary_path: str, text: str, words: list[bytes] | None) -> str:
    return _shipped(docs.sparkSession, vocabulary_path, frequent_words(docs, vocabulary_path, text) if words is None else words)


def with_ids(docs: DataFrame, vocabulary_path: str, text: str = "text", out: str = "ids", words: list[bytes] | None = None) -> DataFrame:
    """`docs` with an array of ids of `text`; words: a lexicon other than the frequent words of `docs`."""
    name = _lexicon(docs, vocabulary_path, text, words)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(SparkFiles.get(name))
        for batch in batches:
            codes = [c for texts in slices(batch) for c in codec.encode(list(map(_decoded, texts)))]
            ends = np.cumsum([0] + [len(c) // 4 for c in codes], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(codes), "<i4")))

    return docs.withColumn(out, F.arrow_udf(encode, "array<int>")(F.col(text)))


def with_text(docs: DataFrame, vocabulary_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`docs` with the text that an array of ids stands for."""
    name = _shipped(docs.sparkSession, vocabulary_path, [])

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(SparkFiles.get(name))
        for batch in batches:
            yield pa.array(codec.decode([np.asarray(x or [], "<u4").tobytes() for x in batch.to_pylist()]), pa.string())

    return docs.withColumn(out, F.arrow_udf(decode, "string")(F.col(ids)))


def with_ids_and_digests(docs: DataFrame, vocabulary_path: str, text: str = "text", out: str = "bpe", words: list[bytes] | None = None) -> DataFrame:
    """`docs` with a struct of n_tokens, ids, ids_sha256 and decoded_sha256: encodes, then decodes the ids."""
    name = _lexicon(docs, vocabulary_path, text, words)

    def trip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(SparkFiles.get(name))
        for batch in batches:
            n, coded, decoded, raw = [], [], [], []
            for texts in slices(batch):
                codes = codec.encode(list(map(_decoded, texts)))
                raw.append(b"".join(codes))
                n += [len(c) // 4 for c in codes]
                coded += [hashlib.sha256(c).hexdigest() for c in codes]
                decoded += [hashlib.sha256(t.encode()).hexdigest() for t in codec.decode(codes)]
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n], dtype=np.int32)), pa.array(np.frombuffer(b"".join(raw), "<i4")))
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), ids, pa.array(coded, pa.string()), pa.array(decoded, pa.string())], ["n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    return docs.withColumn(out, F.arrow_udf(trip, "struct<n_tokens:bigint,ids:array<int>,ids_sha256:string,decoded_sha256:string>")(F.col(text)))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_bpe(spark, sf_dir: str, vocabulary_path: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = with_ids_and_digests(docs, vocabulary_path or default_vocabulary())
    return coded.select("doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")
