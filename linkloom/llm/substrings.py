"""Substring dedup by recompression: words covered by a window of 13 that starts in an earlier document go.

Symbols are named by their content alone, so that all executors give equal stretches equal names without a
dictionary to join. A word's name is a hash of its bytes. Each of three rounds names pairs: the round gives
every symbol a side by a bit of its name, a symbol of the left side joins the next one if that is of the right
side, and the pair's name is made of both names. Equal neighbours have equal sides and never pair, so that a
run of one word stays a run of one symbol. The third round only joins symbols to six words or fewer.

Whether there is a boundary between two words after a round thus depends on few words around it: one, two and
four on either side after the first, second and third round. Every window of 13 words has six places that have
four words of its own on either side, and one of them at least is a boundary of the third round, as no symbol
is longer. A boundary's core is the two symbols that meet there and what is missing of the four words on
either side; its name is made of theirs. Its level says in how many further rounds the two symbols, as they
are, would not join. A window goes by its boundaries of the highest level; equal windows have equal cores and
levels at equal places.

Spark's rounds find what is shared:

1. Documents whose whole text a smaller document has are found by a digest; all their windows are repeats.
2. The names of cores are gathered; those that occur in several documents are shared. A run is posted once.
3. Each other document gets the names of its shared cores. Windows whose cores are all shared are named in
   full, and for each of these names the smallest document and a place in it are found.
4. What a document has from a smaller one is chained to passages, stretches of the smaller document, whose words
   are fetched from there.
5. Each document compares its words with those of its passages and loses the words of the windows that are equal.
   A window whose name is that of a passage's window but whose words differ (a clash of names) is looked up
   among all windows of that name by its words, so that no repeat depends on a name being unique.

Uneven keys, such as a passage in a third of all documents, are counted after partial aggregation and joined
by sort-merge joins with an exchange on either side, which adaptive execution can split. Tables between the
steps are in the shared folder and deleted once used.

Edge cases: a null text has no words; a document of fewer than 13 words loses nothing; a document whose id is
null neither loses words nor takes any from others; rows with the same id are one document for what counts
as smaller, and each is judged by its own text; ids may be of any type that has an order; long texts are read
whole, their words hashed in blocks; an empty table gives no rows. Columns of the input stay, whatever their
names; `without_repeats` replaces `text`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import Shelf, slices, spare_names, table

WINDOW = 13
AROUND = 4  # words on either side that decide on a boundary of the third round
ROUNDS = 3
LONGEST = WINDOW - 2 * AROUND + 1  # words of a symbol of the third round: as many as a window has places
LEVELS = 8
#: Passages of one document that are fetched at once.
FETCHED = 50_000
#: Windows of a smaller document that are chained in one task.
CHAINED = 1024
_ODD = np.array([int.from_bytes(hashlib.sha256(b"window %d" % i).digest()[:8], "little") | 1 for i in range(4 * WINDOW)], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:  # doubling
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        _POWERS[:] = [_powers(_BASE, 2 * n), _powers(pow(_BASE, -1, 1 << 64), 2 * n)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_names(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, name) of every word; a name is a polynomial of the word's bytes, mixed with its length."""
    raw = np.frombuffer(buffer, np.uint8)
    starts, names, at = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
    while at < len(raw):
        to = min(len(raw), at + _BLOCK)
        while to < len(raw) and not _SPACE[raw[to]]:  # blocks end between words
            ahead = np.flatnonzero(_SPACE[raw[to : to + 4096]])
            to += int(ahead[0]) if len(ahead) else len(raw[to : to + 4096])
        part = raw[at:to]
        edge = np.diff(np.concatenate([[1], _SPACE[part].view(np.int8), [1]]))
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = powers(len(part) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)])
        names.append(mixed((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64) * _ODD[0]))
        starts.append(at + first)
        at = to
    return np.concatenate(starts), np.concatenate(names)


def sliding(x: np.ndarray, width: int, most: np.ufunc) -> np.ndarray:
    """The greatest (or least) of `width` values from each place on."""
    out, step = x.copy(), 1
    while step < width:
        more = min(step, width - step)
        out[:-more] = most(out[:-more], out[more:])
        step += more
    return out


class Stretch:
    """The words of several texts, one after the other."""

    def __init__(self, texts: list[bytes | None]):
        self.buffer = b"\n".join(t or b"" for t in texts)
        lengths = np.array([len(t or b"") + 1 for t in texts], np.int64)
        where, self.name = word_names(self.buffer)
        edges = np.searchsorted(where, np.concatenate([[0], np.cumsum(lengths)]))
        self.start, self.size = edges[:-1], np.diff(edges)
        self.doc = np.repeat(np.arange(len(texts)), self.size)

    def words(self) -> list[bytes]:
        return self.buffer.split()  # on bytes: white space as \x20\x09-\x0D

    def boundaries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, names of cores, levels) of the third round's boundaries with AROUND words of their text on either side.

        A place is the word after the boundary.
        """
        place, name, doc, size = np.arange(len(self.name)), self.name, self.doc, np.ones(len(self.name), np.int64)
        for k in range(ROUNDS):
            left = (name >> np.uint64(7 + 11 * k)) & np.uint64(1) == 0
            near = doc[:-1] == doc[1:]
            joins = near & left[:-1] & ~left[1:] & (size[:-1] + size[1:] <= LONGEST)
            if k == ROUNDS - 1:
                break
            first = np.flatnonzero(joins)
            name, size = name.copy(), size.copy()
            name[first] = mixed(name[first] * _ODD[1] + name[first + 1] * _ODD[2] + np.uint64(k))
            size[first] += size[first + 1]
            stay = np.ones(len(name), bool)
            stay[first + 1] = False
            place, name, doc, size = place[stay], name[stay], doc[stay], size[stay]
        before = np.flatnonzero(near & ~joins)
        at = place[before + 1]
        inside = at - self.start[self.doc[at]]
        ok = (inside >= AROUND) & (self.size[self.doc[at]] - inside >= AROUND)
        before, at = before[ok], at[ok]
        core = name[before] * _ODD[3] + name[before + 1] * _ODD[4]
        for j in range(1, AROUND):  # what the two symbols leave of the words around
            core += np.where(size[before] <= j, self.name[at - 1 - j], np.uint64(0)) * _ODD[5 + j]
            core += np.where(size[before + 1] <= j, self.name[at + j], np.uint64(0)) * _ODD[5 + AROUND + j]
        stays, level = np.ones(len(at), bool), np.ones(len(at), np.int16)
        sides = mixed(name + _ODD[0])
        for k in range(LEVELS):
            left = (sides >> np.uint64(k)) & np.uint64(1) == 0
            stays &= ~(left[before] & ~left[before + 1])
            level += stays
        return at, mixed(core), level

    def windows(self) -> np.ndarray:
        """The places where windows start."""
        begin = np.arange(max(0, len(self.name) - WINDOW + 1))
        return begin[self.doc[begin] == self.doc[begin + WINDOW - 1]] if len(begin) else begin

    def window_names(self, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """(places where windows start, their names of so many bits)."""
        begin, n = self.windows(), len(self.name)
        names = np.empty(n, np.uint64)
        up, down = powers(min(n, _BLOCK) + WINDOW + 1)
        for at in range(0, max(0, n - WINDOW + 1), _BLOCK):
            part = self.name[at : at + _BLOCK + WINDOW - 1]
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[: len(part)], dtype=np.uint64)])
            m = len(part) - WINDOW + 1
            names[at : at + m] = mixed((total[WINDOW:] - total[:-WINDOW]) * down[:m])
        return begin, names[begin] >> np.uint64(64 - bits)

    def repeated(self, begin: np.ndarray, name: np.ndarray) -> np.ndarray:
        """Whether each window is equal to that a word before it, in a run of one word."""
        out = np.zeros(len(begin), bool)
        out[1:] = (name[1:] == name[:-1]) & (np.diff(begin) == 1)
        if out.any():
            words = self.words()
            out[out] = [words[b - 1 : b + WINDOW - 1] == words[b : b + WINDOW] for b in begin[out].tolist()]
        return out

    def highest(self, at: np.ndarray, level: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """For windows that start at `begin`: the highest level of the boundaries that they have."""
        levels = np.zeros(len(self.name), np.int16)
        levels[at] = level
        return sliding(levels, LONGEST, np.maximum)[begin + AROUND]

    def owners(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(places, names of cores, levels) of the boundaries that some window goes by, and where windows start."""
        at, core, level = self.boundaries()
        begin = self.windows()
        least = np.full(len(self.name), LEVELS + 2, np.int16)  # of the windows whose places begin here
        least[begin + AROUND] = self.highest(at, level, begin)
        used = level >= sliding(least[::-1], LONGEST, np.minimum)[::-1][at]
        return at[used], core[used], level[used], begin

    def shared_windows(self, shared: Callable[[np.ndarray, np.ndarray], np.ndarray], bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """(starts, names) of the windows all of whose cores are shared; shared: for (texts, cores) whether each is."""
        at, core, level, begin = self.owners()
        amiss = ~shared(self.doc[at], core)
        fine = self.highest(at, 2 * level + amiss, begin) % 2 == 0  # odd where one of the highest level is not shared
        starts, names = self.window_names(bits)
        return starts[fine], names[fine]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _picked(column: pa.Array, at: int, rows: np.ndarray) -> pa.Array:
    return column.take(pa.array(at + rows))


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id) of the cores that windows go by; a run of equal ones is posted once."""
    for batch in batches:
        ids, at = batch.column("doc_id"), 0
        for texts in slices(batch.column("text")):
            s = Stretch(texts)
            spots, key, *_ = s.owners()
            doc = s.doc[spots]
            one = np.ones(len(key), bool)
            one[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            yield pa.RecordBatch.from_arrays([_signed(key[one]), _picked(ids, at, doc[one])], ["key", "doc_id"])
            at += len(texts)


def _blend(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """One number for a text's place and a name; a clash only means a needless candidate."""
    return mixed(key + doc.astype(np.uint64) * _ODD[4 * AROUND])


def _windows(bits: int):
    """For mapInArrow over (doc_id, mark, text, keys): (name, doc_id, mark, at) of the windows whose cores are all in keys; of all where keys is null."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                keys = batch.column("keys").slice(at, len(texts))
                flat, size = keys.flatten().to_numpy().view(np.uint64), np.array([0 if k is None else k for k in keys.value_lengths().to_pylist()], np.int64)
                every = np.array(keys.is_null())
                known = np.sort(_blend(np.repeat(np.arange(len(texts)), size), flat))

                def shared(doc: np.ndarray, core: np.ndarray, known=known, every=every) -> np.ndarray:
                    mine = _blend(doc, core)
                    place = np.minimum(np.searchsorted(known, mine), max(len(known) - 1, 0))
                    return every[doc] | (known[place] == mine if len(known) else False)

                s = Stretch(texts)
                begin, name = s.shared_windows(shared, bits)
                one = ~s.repeated(begin, name)
                begin, name = begin[one], name[one]
                doc = s.doc[begin]
                place = (begin - s.start[doc]).astype(np.int64)
                place = np.where(every[doc], -2 * place - 2, place)  # of one of several texts: not to be chained (see placed)
                yield pa.RecordBatch.from_arrays([_signed(name), _picked(batch.column("doc_id"), at, doc), _picked(batch.column("mark"), at, doc), pa.array(place)], ["name", "doc_id", "mark", "at"])
                at += len(texts)

    return windows


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before it."""
    codes = column.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return np.concatenate([[True], codes[1:] != codes[:-1]])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From windows (doc_id, mark, low_doc, low_at, name) in order: stretches (…, low_at, count, name of the first) of consecutive ones."""
    for batch in batches:
        if not len(batch):
            continue
        low = batch.column("low_at").to_numpy()
        other = _changes(batch.column("doc_id")) | _changes(batch.column("mark")) | _changes(batch.column("low_doc"))
        name = batch.column("name").to_numpy()
        step, same = np.diff(low, prepend=low[0]), name == np.concatenate([name[:1], name[:-1]])
        first = np.flatnonzero(other | ~((step == 1) | (step == 0) & same))  # the same window comes from each place that a text has it at
        last = np.append(first[1:], len(low)) - 1
        own = batch.take(pa.array(first))
        yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("mark"), own.column("low_doc"), own.column("low_at"), pa.array(low[last] - low[first] + 1), own.column("name")], ["doc_id", "mark", "low_doc", "low_at", "n", "name"])


def placed(at: int) -> int:
    """The place that `at` stands for. Those of documents with one text are themselves; others are negative and even, so that none follows another."""
    return at if at >= 0 else -at // 2 - 1


def _passages(bits: int):
    """For mapInArrow over (doc_id, text, wanted): the words of each wanted passage (low_at, n, name) that the text has there."""

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                out: list[tuple] = []
                s = Stretch(texts)
                words, (begin, names) = s.words(), s.window_names(bits)
                for k, wanted in enumerate(batch.column("wanted").slice(at, len(texts)).to_pylist()):
                    own = slice(*np.searchsorted(begin, [s.start[k], s.start[k] + s.size[k]]))
                    for w in wanted:
                        place = placed(w["low_at"]) + own.start
                        if place + w["n"] <= own.stop and names[place : place + 1].view(np.int64)[0] == w["name"]:
                            a = int(begin[place])
                            out.append((at + k, w["low_at"], w["n"], w["name"], b" ".join(words[a : a + w["n"] + WINDOW - 1])))
                cols = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(cols[0], pa.int64())), *[pa.array(c, pa.int64()) for c in cols[1:4]], pa.array(cols[4], pa.binary())], ["low_doc", "low_at", "n", "name", "words"])
                at += len(texts)

    return passages


def kept_words(texts: list[bytes | None], passages: list[list[bytes]], copies: list[bool], bits: int = 64) -> list[tuple[int, list[bytes], list[tuple[int, int, bytes]]]]:
    """For each text: its number of words; the words that no window equal to one of its passages' covers (all windows of a copy are); windows that only share a name.

    The latter are (place, name, words).
    """
    out: list = [None] * len(texts)
    some = [i for i, p in enumerate(passages) if p and not copies[i]]
    for i in set(range(len(texts))) - set(some):
        words = (texts[i] or b"").split()
        out[i] = (len(words), [] if copies[i] and len(words) >= WINDOW else words, [])
    if not some:
        return out
    own, given = Stretch([texts[i] for i in some]), Stretch([p for i in some for p in passages[i]])
    owner = np.repeat(np.arange(len(some)), [len(passages[i]) for i in some])
    (begin, names), (place, theirs) = own.window_names(bits), given.window_names(bits)
    mine, known = _blend(own.doc[begin], names), _blend(owner[given.doc[place]], theirs)
    order = np.argsort(known, kind="stable")
    known, place = known[order], place[order]
    spot = np.minimum(np.searchsorted(known, mine), len(known) - 1)
    hit = np.flatnonzero(known[spot] == mine)
    begin, names, to, spot = begin[hit], names[hit], place[spot[hit]], spot[hit]
    words, their = own.words(), given.words()
    edges = np.zeros(len(words) + 1, np.int64)
    amiss: list[list] = [[] for _ in some]
    if len(hit):
        chain = np.flatnonzero(np.concatenate([[True], (np.diff(begin) != 1) | (np.diff(to) != 1) | (np.diff(own.doc[begin]) != 0) | (np.diff(given.doc[to]) != 0)]))
        for a, b in zip(chain.tolist(), [*chain[1:].tolist(), len(hit)], strict=True):
            i, j, n = int(begin[a]), int(to[a]), b - a + WINDOW - 1
            if words[i : i + n] == their[j : j + n]:
                edges[i] += 1
                edges[i + n] -= 1
                continue
            for k in range(a, b):  # one by one, with every window of the name
                i, w = int(begin[k]), words[begin[k] : begin[k] + WINDOW]
                end = int(np.searchsorted(known, known[spot[k]], "right"))
                if any(w == their[j : j + WINDOW] for j in place[spot[k] : end].tolist()):
                    edges[i] += 1
                    edges[i + WINDOW] -= 1
                else:
                    amiss[int(own.doc[i])].append((i - int(own.start[own.doc[i]]), int(names[k : k + 1].view(np.int64)[0]), b" ".join(w)))
    gone = (np.cumsum(edges)[:-1] > 0).tolist()
    for k, i in enumerate(some):
        a, b = int(own.start[k]), int(own.start[k] + own.size[k])
        out[i] = (b - a, [w for w, g in zip(words[a:b], gone[a:b], strict=True) if not g], amiss[k])
    return out


_AMISS = "array<struct<at:bigint,name:bigint,words:binary>>"
_AMISS_ARROW = pa.list_(pa.struct([("at", pa.int64()), ("name", pa.int64()), ("words", pa.binary())]))
Shown = Callable[[list[bytes | None], list[tuple[int, list[bytes]]]], pa.Array]


def _judge(shown: Shown, kind: str, bits: int):
    """An Arrow function of (text, passages, copy): what `shown` makes of the kept words, and the windows that only share a name."""

    def judge(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, given, copies in batches:
            parts, amiss, at = [], [], 0
            for part in slices(batch):
                passages = [p or [] for p in given.slice(at, len(part)).to_pylist()]
                same = [bool(c) for c in copies.slice(at, len(part)).to_pylist()]
                rows = kept_words(part, passages, same, bits)
                parts.append(shown(part, [(n, k) for n, k, _ in rows]))
                amiss += [[{"at": a, "name": b, "words": w} for a, b, w in x] for _, _, x in rows]
                at += len(part)
            made = pa.concat_arrays(parts) if parts else shown([], [])
            yield pa.StructArray.from_arrays([made, pa.array(amiss, _AMISS_ARROW)], ["made", "amiss"])

    return F.arrow_udf(judge, f"struct<made:{kind},amiss:{_AMISS}>")


def _digests(texts: list[bytes | None], kept: list[tuple[int, list[bytes]]]) -> pa.Array:
    cols = [[n for n, _ in kept], [n - len(k) for n, k in kept], [hashlib.sha256(b" ".join(k)).hexdigest() for _, k in kept]]
    return pa.StructArray.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["n_words", "n_removed", "kept_sha256"])


def _texts(texts: list[bytes | None], kept: list[tuple[int, list[bytes]]]) -> pa.Array:
    return pa.array([None if t is None else b" ".join(k).decode("utf-8", "replace") for t, (_, k) in zip(texts, kept, strict=True)], pa.string())


def _mark(text: Column) -> Column:
    """What tells the texts of one id apart."""
    return F.xxhash64(text)


def _shared_keys(own: DataFrame, status: DataFrame, shelf: Shelf) -> DataFrame:
    """(doc_id, keys): the shared cores of each document that has a first text; null, for all, where an id has several texts."""
    kind = own.schema["doc_id"].dataType.simpleString()
    postings = shelf.put("postings", own.select("doc_id", "text").mapInArrow(_postings, f"key bigint, doc_id {kind}"))
    shared = shelf.put("shared", postings.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("key"))
    shelf.drop(sweep=True)
    single = status.where("first and texts = 1").select("doc_id")
    keys = postings.join(shared, "key").join(single, "doc_id").groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    found = shelf.put("keys", keys.unionByName(status.where("first and texts > 1").select("doc_id", F.lit(None).cast("array<bigint>").alias("keys"))))
    shelf.drop("postings", "shared", sweep=True)
    return found


def _stretches(own: DataFrame, keys: DataFrame, bits: int, shelf: Shelf) -> tuple[DataFrame, DataFrame]:
    """(windows that may be shared, stretches of smaller documents that a text's windows have the names of)."""
    kind = own.schema["doc_id"].dataType.simpleString()
    marked = own.withColumn("mark", _mark(F.col("text")))
    found = shelf.put("windows", marked.join(keys, "doc_id").select("doc_id", "mark", "text", "keys").mapInArrow(_windows(bits), f"name bigint, doc_id {kind}, mark bigint, at bigint"))
    shelf.drop("keys", sweep=True)
    least = found.groupBy("name").agg(F.min("doc_id").alias("low_doc"), F.min_by("at", "doc_id").alias("low_at"), F.max("doc_id").alias("high"))
    low = shelf.put("least", least.where("low_doc < high").drop("high"))
    shelf.drop(sweep=True)
    hits = found.join(low, "name").where("doc_id > low_doc").select("doc_id", "mark", "low_doc", "low_at", "name")
    order = ["doc_id", "mark", "low_doc", "low_at", "name"]
    dealt = hits.repartition("doc_id", "mark", "low_doc", F.floor(F.col("low_at") / CHAINED)).sortWithinPartitions(*order)
    chained = dealt.mapInArrow(_chained, f"doc_id {kind}, mark bigint, low_doc {kind}, low_at bigint, n bigint, name bigint")
    out = shelf.put("stretches", chained)
    shelf.drop("least", sweep=True)
    return found, out


def _fetched(own: DataFrame, stretches: DataFrame, bits: int, shelf: Shelf) -> DataFrame:
    """(doc_id, mark, passages): the words of the stretches of each text."""
    kind, at = own.schema["doc_id"].dataType.simpleString(), ["low_doc", "low_at", "n", "name"]
    wanted = shelf.put("wanted", stretches.select(*at).distinct())
    parts = wanted.groupBy("low_doc").agg(F.ceil(F.count("*") / F.lit(FETCHED)).alias("parts"))
    part = F.pmod(F.xxhash64("low_at", "n", "name"), F.col("parts"))
    lists = wanted.join(parts, "low_doc").groupBy("low_doc", part.alias("part")).agg(F.collect_list(F.struct("low_at", "n", "name")).alias("wanted"))
    asked = own.join(lists, own["doc_id"] == lists["low_doc"]).select("doc_id", "text", "wanted")
    words = shelf.put("passages", asked.mapInArrow(_passages(bits), f"low_doc {kind}, low_at bigint, n bigint, name bigint, words binary").distinct())
    marks = shelf.put("marks", stretches.join(words, at).groupBy("doc_id", "mark").agg(F.collect_list("words").alias("passages")))
    shelf.drop("wanted", "passages", "stretches", sweep=True)
    return marks


def _looked_up(own: DataFrame, found: DataFrame, amiss: DataFrame, bits: int, shelf: Shelf) -> DataFrame:
    """(doc_id, mark, passages): of windows `amiss` (doc_id, mark, name, words) those whose words a smaller document has too."""
    kind = own.schema["doc_id"].dataType.simpleString()
    places = found.join(amiss.select("name").distinct(), "name").groupBy("doc_id", "mark").agg(F.collect_list(F.struct(F.col("at").alias("low_at"), F.lit(1).cast("bigint").alias("n"), "name")).alias("wanted"))
    marked = own.withColumn("mark", _mark(F.col("text"))).join(places, ["doc_id", "mark"]).select("doc_id", "text", "wanted")
    words = marked.mapInArrow(_passages(bits), f"low_doc {kind}, low_at bigint, n bigint, name bigint, words binary")
    low = shelf.put("low", words.groupBy("words").agg(F.min("low_doc").alias("low_doc")))
    return amiss.join(low, "words").where("low_doc < doc_id").groupBy("doc_id", "mark").agg(F.collect_set("words").alias("passages"))


def deduplicated(docs: DataFrame, shown: Shown, kind: str, out: str, keep: list[str], bits: int = 64) -> DataFrame:
    """The columns `keep` of `docs` (doc_id, text) and `out`, of type `kind`: what `shown` makes of each text's kept words."""
    shelf = Shelf(docs.sparkSession, "substrings")
    own = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    # copies of a whole text are settled first: only the smallest of them goes on
    digests = shelf.put("digests", own.select("doc_id", _mark(F.col("text")).alias("mark"), F.sha2(F.col("text").cast("binary"), 256).alias("digest")).distinct())
    least = shelf.put("firsts", digests.groupBy("digest").agg(F.min("doc_id").alias("low")))
    judged = shelf.put("judged", digests.join(least, "digest").select("doc_id", "mark", "digest", (F.col("doc_id") > F.col("low")).alias("copy")))
    shelf.drop("digests", "firsts", sweep=True)
    status = shelf.put("status", judged.groupBy("doc_id").agg(F.count("*").alias("texts"), F.bool_or(~F.col("copy")).alias("first")))
    copies = judged.where("copy").groupBy("doc_id", "mark").agg(F.collect_list("digest").alias("copied"))
    found, stretches = _stretches(own, _shared_keys(own, status, shelf), bits, shelf)
    marks = _fetched(own, stretches, bits, shelf)

    def result(marks: DataFrame, name: str) -> DataFrame:
        its_id, its_mark, passages, copied, both = spare_names(docs.columns, "its_id", "its_mark", "passages", "copied", "both")
        known = marks.join(copies, ["doc_id", "mark"], "full_outer").select(F.col("doc_id").alias(its_id), F.col("mark").alias(its_mark), F.col("passages").alias(passages), F.col("copied").alias(copied))
        joined = docs.join(known, (docs["doc_id"] == F.col(its_id)) & (_mark(docs["text"]) == F.col(its_mark)), "left")
        copy = F.when(F.col(copied).isNotNull(), F.array_contains(copied, F.sha2(F.col("text").cast("binary"), 256)))
        made = joined.withColumn(both, _judge(shown, kind, bits)("text", passages, copy))
        clash, of = spare_names([*docs.columns, out], "amiss", "mark")
        columns = [c for c in keep if c != out]
        return shelf.put(name, made.select(*columns, F.col(f"{both}.made").alias(out), F.col(f"{both}.amiss").alias(clash), _mark(F.col("text")).alias(of), F.col("doc_id").alias(its_id))), clash, of, its_id

    first, clash, of, its_id = result(marks, "result")
    amiss = first.where(F.size(clash) > 0).select(F.col(its_id).alias("doc_id"), F.col(of).alias("mark"), F.explode(clash).alias("x")).select("doc_id", "mark", "x.name", "x.words").distinct()
    if not amiss.isEmpty():
        more = _looked_up(own, found, shelf.put("amiss", amiss), bits, shelf)
        marks = marks.unionByName(more).groupBy("doc_id", "mark").agg(F.flatten(F.collect_list("passages")).alias("passages"))
        first = result(marks, "again")[0]
    shelf.clear("result", "again")
    return first.drop(clash, of, its_id)


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with the repeated words taken out of `text`, whose kept words are then joined by single spaces; a table in the shared folder."""
    return deduplicated(docs, _texts, "string", "text", docs.columns).select(*docs.columns)


_KEPT = "struct<n_words:bigint,n_removed:bigint,kept_sha256:string>"


def op9_substrings(spark, sf_dir: str, bits: int = 64) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs, _digests, _KEPT, "kept", ["doc_id"], bits).select("doc_id", "kept.*")


OP9_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM doc WHERE len(w) >= 13)
), low AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN low USING (s) WHERE doc_id > m) GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t
  FROM (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS p FROM doc) d
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(ps) AS p FROM gone) g WHERE g.doc_id = d.doc_id AND g.p = d.p)
  GROUP BY doc_id
)
SELECT doc.doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
