"""Benchmark decontamination by Wu-Manber multi-pattern search.

Every benchmark item gives windows of ten consecutive words (an item of fewer words is one window). The
windows are compiled into classes in which no window is over three times as long as another. A class of least length m has a table that says, for
each block of B bytes, how far the search may move on because no window has that block nearer to its m-th
byte; blocks on which windows' first m bytes end lead to a bucket, ordered by that suffix and by the
window's first bytes, and a direct comparison of all bytes confirms an occurrence.

The search moves many positions at once: the text of a slice is cut into lanes, and each step looks up the
block under every lane that has not reached its end. Texts are searched whole.

The items are dealt out by a hash into blocks of about `BLOCK_CHARS` characters of benchmark text (or one longer
item). A task compiles each block and writes its tables to the shared folder; only the files' names pass through the
driver. The search reads them there, block after block for each batch of documents, in one narrow step.

Edge cases: a null or empty text, or one without words, has no words and no hits; a long text is searched
whole; null or wordless items give no window; an item whose id is null marks words but is listed nowhere;
without items nothing is hit; repeated rows give the same result once for each row, repeated items count once;
an empty table gives no rows. `with_benchmark_hits` replaces a column that has the name of its result, as
withColumn does; all other columns stay, whatever their names.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import fresh_folder, opened, slices, spare_names, table

WINDOW = 10
BLOCK_CHARS = 2_000_000
LANE_BYTES = 1024
#: Lower-cases A-Z and turns what is no word byte into a space: words are 0-9, a-z and all beyond ASCII.
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def folded_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def item_windows(text: str | None, size: int = WINDOW) -> set[bytes]:
    """The windows of an item, each with a space before and after every word."""
    words = folded_words(text.encode("utf-8", "replace") if text else None)
    if not words:
        return set()
    return {b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))}


class LengthClass:
    """Tables for windows of at least `least` bytes."""

    def __init__(self, windows: list[bytes], ids: np.ndarray):
        self.least = m = min(map(len, windows))
        self.ids = ids
        self.windows = windows
        # wide enough that a random block is seldom one of the windows' blocks
        self.block = b = int(min(8, m, max(2, np.ceil(np.log(2.0 * len(windows) * m) / np.log(8)))))
        self.mask = np.uint64((1 << (8 * b)) - 1)
        self.head_mask = np.uint64((1 << (8 * min(8, m))) - 1)
        self.bits = int(np.clip(np.ceil(np.log2(4.0 * len(windows) * m)), 12, 20))
        heads = np.frombuffer(b"".join(w[:m] for w in windows), np.uint8).reshape(len(windows), m)
        padded = np.zeros((len(windows), m + 8), np.uint8)
        padded[:, :m] = heads
        self.shift = np.full(1 << self.bits, m - b + 1, np.int32)
        for end in range(b, m + 1):  # ends nearer to m overwrite greater shifts
            self.shift[self._slot(self._load(padded, end - b))] = m - end
        suffix, prefix = self._load(padded, m - b) & self.mask, self._load(padded, 0) & self.head_mask
        key = self._key(suffix, prefix)
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    @staticmethod
    def _load(rows: np.ndarray, at: int) -> np.ndarray:
        return np.ascontiguousarray(rows[:, at : at + 8]).view("<u8")[:, 0]

    def _slot(self, block: np.ndarray) -> np.ndarray:
        return ((block & self.mask) * _MIX) >> np.uint64(64 - self.bits)

    @staticmethod
    def _key(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return (suffix * _MIX) ^ (prefix * np.uint64(0xC2B2AE3D27D4EB4F))

    def occurrences(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(start, window's number) of every occurrence; `text` ends in 8 bytes that no window has."""
        n, m, b = len(text) - 8, self.least, self.block
        if n < m:
            return
        words = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))  # the 8 bytes from each place
        limit = np.minimum(np.arange(0, n + 1, LANE_BYTES) + LANE_BYTES, n + 1)
        at = np.maximum(limit - LANE_BYTES, m)  # ends of the m bytes under each lane
        at[-1] = max(at[-1], (len(at) - 1) * LANE_BYTES, m)
        alive = at < limit
        at, limit = at[alive], limit[alive]
        ends, blocks = [], []
        while len(at):
            block = words[at - b]
            step = self.shift[self._slot(block)]
            if not step.all():
                stop = step == 0
                ends.append(at[stop])
                blocks.append(block[stop])
                step = np.maximum(step, 1)
            at = at + step
            alive = at < limit
            if not alive.all():
                at, limit = at[alive], limit[alive]
        if not ends:
            return
        starts = np.concatenate(ends) - m
        key = self._key(np.concatenate(blocks) & self.mask, words[starts] & self.head_mask)
        low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        for i in np.flatnonzero(high > low):
            start = int(starts[i])
            for k in self.order[low[i] : high[i]]:
                if text.startswith(self.windows[k], start):
                    yield start, int(self.ids[k])


class WindowSearch:
    """All windows of a block of items, by classes of length."""

    def __init__(self, items: list[tuple[int | str | None, str | None]], size: int = WINDOW):
        owners = defaultdict(set)
        for item_id, text in items:
            for w in item_windows(text, size):
                owners[w].add(None if item_id is None else str(item_id))
        self.windows = sorted(owners)
        self.owners = [sorted(x for x in owners[w] if x is not None) for w in self.windows]
        self.n_words = [w.count(b" ") - 1 for w in self.windows]
        grades: list[list[int]] = []
        for k in sorted(range(len(self.windows)), key=lambda k: len(self.windows[k])):
            if not grades or len(self.windows[k]) > 3 * len(self.windows[grades[-1][0]]):
                grades.append([])
            grades[-1].append(k)
        self.classes = [LengthClass([self.windows[k] for k in ks], np.array(ks)) for ks in grades]

    def search(self, texts: list[bytes | None]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """For each text: words, hit stretches of words (start, end; apart and in order), items found."""
        parts, places, counts, at = [], [], [], 0
        for text in texts:
            words = folded_words(text)
            part = b"\n " + b" ".join(words) + b" " if words else b"\n"
            parts.append(part)
            places.append(at)
            counts.append(len(words))
            at += len(part)
        buffer = b"".join(parts) + b"\n" * 8
        found = defaultdict(list)
        for grade in self.classes:
            for start, k in grade.occurrences(buffer):
                found[int(np.searchsorted(places, start, "right")) - 1].append((start, k))
        results = []
        for i, n in enumerate(counts):
            if i not in found:
                results.append((n, [], []))
                continue
            gaps = np.flatnonzero(np.frombuffer(parts[i], np.uint8) == 32)
            edges = np.zeros(n + 1, np.int64)
            items = set()
            for start, k in found[i]:
                first = int(np.searchsorted(gaps, start - places[i]))
                edges[first] += 1
                edges[first + self.n_words[k]] -= 1
                items.update(self.owners[k])
            change = np.diff(np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8)]))
            results.append((n, list(zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist(), strict=True)), sorted(items)))
        return results


_FOUND = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("n_hit", pa.int64()), ("items", pa.list_(pa.string()))])


def compiled_blocks(benchmark: DataFrame, size: int = WINDOW, block_chars: int = BLOCK_CHARS) -> list[str]:
    """Compiles the items (item_id, text) in blocks; the paths of the files, of which there is one for each block."""
    spark = benchmark.sparkSession
    slim = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    chars = slim.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-chars // block_chars))
    folder = fresh_folder(spark, "benchmark")

    def compiled(block: pa.Table) -> pa.Table:
        path = f"{folder}/{uuid4().hex}.bin"  # a new one for each attempt
        place, at = opened(path)
        with place.open_output_stream(at, compression=None) as f:
            pickle.dump(WindowSearch(list(zip(block["item_id"].to_pylist(), block["text"].to_pylist(), strict=True)), size), f)
        return pa.table({"path": [path]})

    blocks = slim.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    return sorted(r.path for r in blocks.groupBy("block").applyInArrow(compiled, "path string").collect())


@lru_cache(maxsize=2)
def _searcher(path: str | None, size: int) -> WindowSearch:
    if path is None:
        return WindowSearch([], size)
    place, at = opened(path)
    with place.open_input_stream(at, compression=None) as f:
        return pickle.loads(f.read())


def joined_stretches(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches that are apart, in order, and cover the same places."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def with_benchmark_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "leak", size: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """`docs` with a struct column `out`: n_words, hits (stretches of words), n_hit and items (their ids, as strings)."""
    paths = compiled_blocks(benchmark, size, block_chars) or [None]

    @F.arrow_udf("struct<n_words:bigint,hits:array<struct<start:int,end:int>>,n_hit:bigint,items:array<string>>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n_words, hits, items = [0] * len(batch), [[] for _ in range(len(batch))], [set() for _ in range(len(batch))]
            for path in paths:
                searcher, row = _searcher(path, size), 0
                for texts in slices(batch):
                    for n, stretches, found in searcher.search(texts):
                        n_words[row] = n
                        hits[row] += stretches
                        items[row].update(found)
                        row += 1
            whole = [joined_stretches(h) for h in hits]
            rows = [{"n_words": n, "hits": [{"start": a, "end": b} for a, b in h], "n_hit": sum(b - a for a, b in h), "items": sorted(i)} for n, h, i in zip(n_words, whole, items, strict=True)]
            yield pa.array(rows, _FOUND)

    return docs.withColumn(out, search(F.col(text)))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark window, with the columns that they had."""
    (leak,) = spare_names(docs.columns, "leak")
    return with_benchmark_hits(docs, benchmark, out=leak).where(F.col(f"{leak}.n_hit") == 0).drop(leak)


def digest(values: Column) -> Column:
    return F.sha2(F.array_join(values, ","), 256)


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = with_benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        F.col("leak.n_words").alias("n_words"),
        F.col("leak.n_hit").alias("n_hit"),
        F.size("leak.items").cast("long").alias("n_items"),
        digest(F.col("leak.items")).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


OP2_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT item_id, least(len(w), 10) AS k, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS s
  FROM item WHERE len(w) > 0
), lens AS (SELECT DISTINCT k FROM win
), shot AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, lens WHERE len(w) >= k)
), hit AS (
  SELECT doc_id, item_id, win.k AS k, i FROM shot JOIN win ON win.k = shot.k AND win.s = shot.s
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
