"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

A fingerprint has eight bytes. Two that differ in `MOST_BITS` bits or fewer differ in at most as many bytes, so
that they share the bytes of at least `LEAST_SHARED` positions. The index posts each distinct fingerprint under
the bytes of three positions at a time. For two fingerprints in a posting list the positions where their
bytes are equal are tallied; a pair with fewer than `LEAST_SHARED` is dropped, the others are verified by their
differing bits. Such a pair meets in the list of its three lowest shared positions and is taken there; a
fourth lies above these, so that lists with the highest position need not be made.

Copies have one fingerprint and are one posting. A list gives a star of edges for each connected part of its
members, never all pairs. Lists are counted first. The postings of one with more than `LONG_LIST` members are
dealt out by one more position, above the three, which is where their pairs share a fourth. Within a list of four positions
that is still longer, two link exactly if some value is at most two flipped bits away from both, so each
fingerprint is dealt out to its values by Spark and joined with the least fingerprint there.

The components are found by alternating large-star and small-star rounds; each round's result goes to the
shared folder, and joins with uneven keys are left to adaptive execution, which splits them.

Edge cases: a text without words has fingerprint zero, linked like any other; a null text counts as empty, and
a long one is read whole; repeated rows get the same result; rows with a null doc_id link like others, but a
component's id is the smallest id that is not null (null if it has none); ids may be of any type that has an
order; an empty table gives no rows. `with_fingerprint` replaces a column that has the name of its result, as
withColumn does; `components` returns only its own columns, and `one_of_each` those that it was given.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import Shelf, slices, spare_names, table

SHINGLE = 4
SEED = 42
MOST_BITS = 4
LEAST_SHARED = 8 - MOST_BITS
#: Positions of a posting's bytes; one less than are shared at least, so that the tally decides.
POSTED = LEAST_SHARED - 1
LONG_LIST = 1024
#: Lists up to this size are compared together, longer ones one by one.
SHORT_LIST = 48
#: Sets of positions as bits (bit k: byte k, the least significant first); the highest position is left for the fourth.
CHOICES = [sum(1 << p for p in positions) for positions in combinations(range(7), POSTED)]


def _lowest(positions: int, n: int) -> int:
    """The n lowest members of a set, or 0 if it has fewer."""
    members = [1 << p for p in range(8) if positions >> p & 1]
    return sum(members[:n]) if len(members) >= n else 0


#: For each set of shared positions that is large enough: its lowest three, and its lowest four.
_LIST_OF = {n: np.array([_lowest(m, n) if m.bit_count() >= LEAST_SHARED else 0 for m in range(256)], np.int32) for n in (POSTED, LEAST_SHARED)}


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text, as a signed 64-bit integer."""
    words = (text or b"").lower().split()  # on bytes: A-Z only; white space as \x20\x09-\x0D
    if not words:
        return 0
    if len(words) < shingle:
        hashes = xxhash.xxh64_digest(b" ".join(words), SEED)
    else:
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)), strict=False)])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), 4096):
        ones += np.unpackbits(rows[at : at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(t) for texts in slices(batch) for t in texts], pa.int64())

    return docs.withColumn(out, F.arrow_udf(prints, "bigint")(F.col(text)))


def shared_positions(x: np.ndarray) -> np.ndarray:
    """For differences x of fingerprints: the set of byte positions where they are equal."""
    same = np.ascontiguousarray(x).view(np.uint8).reshape(*x.shape, 8) == 0
    return np.packbits(same, axis=-1, bitorder="little")[..., 0]


def links(x: np.ndarray, choice: np.ndarray | int, posted: int) -> np.ndarray:
    """Whether differences x are links that belong to the lists of `choice`: tally the shared positions, then verify the bits."""
    enough = _LIST_OF[posted][shared_positions(x)] == choice  # 0, no choice, where the tally is too low
    return enough & (np.bitwise_count(x) <= MOST_BITS)


def stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n members the least member of the part that the links (i, j) put it in."""
    label = np.arange(n)
    while len(i):
        np.minimum.at(label, np.maximum(label[i], label[j]), np.minimum(label[i], label[j]))
        while (label[label] != label).any():
            label = label[label]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label


def _edges_of_lists(c: np.ndarray, k: np.ndarray, fp: np.ndarray, posted: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges from whole lists, which follow each other."""
    start = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (k[1:] != k[:-1])]))
    size = np.diff(np.append(start, len(c)))
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    short = np.flatnonzero(np.repeat((size > 1) & (size <= SHORT_LIST), size))
    of = np.repeat(np.arange(len(start)), size)[short]
    for d in range(1, min(SHORT_LIST, len(short))):
        i = np.flatnonzero(of[d:] == of[:-d])
        if not len(i):
            break
        i, j = short[i], short[i + d]
        ok = links(fp[i] ^ fp[j], c[i], posted)
        left.append(i[ok])
        right.append(j[ok])
    for s, n in zip(start[size > SHORT_LIST], size[size > SHORT_LIST], strict=True):
        own = fp[s : s + n]
        for at in range(0, n, 256):
            i, j = np.nonzero(links(own[at : at + 256, None] ^ own[None, at:], int(c[s]), posted))
            left.append(s + at + i)
            right.append(s + at + j)
    label = stars(len(c), np.concatenate(left), np.concatenate(right))
    far = np.flatnonzero(label != np.arange(len(c)))
    return fp[label[far]], fp[far]


def _list_edges(posted: int):
    """For mapInArrow over postings in order: edges (a, b). A list is held until it is whole; none has over `LONG_LIST` members."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64))

        def made(c, k, fp) -> pa.RecordBatch:
            a, b = _edges_of_lists(c, k, fp, posted)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            new = [batch.column(x).to_numpy() for x in ("c", "k", "fp")]
            c, k, fp = (np.concatenate([h, n.view(h.dtype)]) for h, n in zip(held, new, strict=True))
            if not len(c):
                continue
            other = np.flatnonzero((c != c[-1]) | (k != k[-1]))
            last = int(other[-1]) + 1 if len(other) else 0
            if last:
                yield made(c[:last], k[:last], fp[:last])
            held = (c[last:], k[last:], fp[last:])
        if len(held[0]):
            yield made(*held)

    return edges


def _bytes_of(choice: int) -> int:
    """The bytes of a set of positions as a mask, signed."""
    mask = sum(255 << (8 * p) for p in range(8) if choice >> p & 1)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _through_middles(long: DataFrame, shelf: Shelf) -> DataFrame:
    """Edges (a, b) within long lists: postings (c, fp) meet at values at most two flipped bits away."""

    def middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, fp = batch.column("c").to_numpy(), batch.column("fp").to_numpy()
            for choice in np.unique(c):
                own = fp[c == choice]
                bits = [1 << (8 * p + i) for p in range(8) if not choice >> p & 1 for i in range(8)]
                flips = np.array([0, *bits, *(x | y for x, y in combinations(bits, 2))], np.uint64)
                for at in range(0, len(own), 1024):
                    some = own[at : at + 1024]
                    mid = (some.view(np.uint64)[:, None] ^ flips[None]).reshape(-1).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mid), choice, np.int32)), pa.array(mid), pa.array(np.repeat(some, len(flips)))], ["c", "mid", "a"])

    dealt = long.select("c", "fp").mapInArrow(middles, "c int, mid bigint, a bigint")
    least = shelf.put("middles", dealt.groupBy("c", "mid").agg(F.min("a").alias("b"), F.max("a").alias("most")).where("b < most").drop("most"))
    return shelf.put("middle-edges", dealt.join(least, ["c", "mid"]).where("a > b").select(F.col("b").alias("a"), F.col("a").alias("b")).distinct())


def _parted(postings: DataFrame, posted: int, long_list: int, shelf: Shelf) -> tuple[DataFrame, DataFrame | None]:
    """Edges from the lists of up to `long_list` postings (c, k, fp), and the postings of the others, None if there are none."""
    counts = postings.groupBy("c", "k").agg(F.count("*").alias("n")).where(F.col("n") > long_list).select("c", "k")
    long = shelf.put(f"long-{posted}", counts)
    some = not long.isEmpty()
    rest = postings.join(long, ["c", "k"], "left_anti") if some else postings
    lists = rest.select("c", "k", "fp").repartition("c", "k").sortWithinPartitions("c", "k")
    edges = shelf.put(f"edges-{posted}", lists.mapInArrow(_list_edges(posted), "a bigint, b bigint"))
    return edges, postings.join(long, ["c", "k"]) if some else None


def link_edges(prints: DataFrame, shelf: Shelf, fp: str = "fp", long_list: int = LONG_LIST) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints of `prints` that connect exactly what links connect; in the shared folder."""
    places = F.array(*[F.struct(F.lit(c).alias("c"), F.col(fp).bitwiseAND(F.lit(_bytes_of(c))).alias("k")) for c in CHOICES])
    threes = prints.select(F.col(fp).alias("fp"), F.inline(places))
    edges, long = _parted(threes, POSTED, long_list, shelf)
    if long is None:
        return edges
    above = long.select("fp", "c", "k", F.explode(F.expr("filter(sequence(0, 7), p -> shiftleft(1, p) > c)")).alias("p"))
    fours = above.selectExpr("c | shiftleft(1, p) as c", "k | (fp & shiftleft(255L, 8 * p)) as k", "fp")
    more, long = _parted(fours, LEAST_SHARED, long_list, shelf)
    edges = edges.unionByName(more)
    return edges if long is None else edges.unionByName(_through_middles(long, shelf))


def connected(edges: DataFrame, shelf: Shelf) -> DataFrame:
    """(node, root): the least node of each node's connected part, for all nodes of `edges` (a, b); in the shared folder."""
    now = shelf.put("star-0", edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark, turn = None, 0
    while True:
        turn = 1 - turn
        # large star: neighbours above a node move to the least of its neighbourhood
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = shelf.put("least-above", both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = shelf.put("large", both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: neighbours below a node, and the node, move to the least of them
        least = shelf.put("least-below", large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = shelf.put(f"star-{turn}", small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if after == mark or after[0] == 0:
            break
        mark = after
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    found = shelf.put("roots", roots)
    shelf.drop("star-0", "star-1", "large", "least-above", "least-below")
    return found


def roots_of(classes: DataFrame, shelf: Shelf, long_list: int = LONG_LIST) -> DataFrame:
    """(fp, root) for every fingerprint of `classes` that is linked with others: the least fingerprint of its component."""
    found = connected(link_edges(classes, shelf, long_list=long_list), shelf).withColumnRenamed("node", "fp")
    shelf.drop("edges-3", "edges-4", "long-3", "long-4", "middles", "middle-edges", sweep=True)
    return found


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", long_list: int = LONG_LIST) -> DataFrame:
    """doc_id, fp and component_id for every row of `docs`."""
    shelf = Shelf(docs.sparkSession, "simhash")
    prints = shelf.put("prints", with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "fp"))
    classes = shelf.put("classes", prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    own = shelf.put("own", roots_of(classes, shelf, long_list).join(classes, "fp"))
    ids = shelf.put("ids", own.groupBy("root").agg(F.min("least").alias("component_id")))
    linked = own.join(ids, "root").select("fp", "component_id")
    known = shelf.put("known", classes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")))
    shelf.clear("prints", "known")
    return prints.join(known, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with the columns that it had: that with the smallest id, nulls last.

    Of rows with the same id in a component the one whose digest of the text is least stays, and of those with
    the same text too the one whose other columns have the least JSON, so that each run keeps the same row.
    """
    shelf = Shelf(docs.sparkSession, "one-of-each")
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    prints = with_fingerprint(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), digest.alias("digest")))
    first = F.struct(F.col("id").isNull().alias("last"), "id", "digest")
    classes = shelf.put("classes", prints.select("fp", first.alias("first")).groupBy("fp").agg(F.min("first").alias("first")))
    roots = roots_of(classes.select("fp"), shelf)
    least = classes.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    own, nth = spare_names(docs.columns, "own", "nth")
    # an id and a digest as one text, so that the rows dealt out for the join are where the numbering wants them
    key = lambda i, d: F.concat(F.when(i.isNull(), "-").otherwise(F.concat(F.lit("+"), i.cast("string"))), F.lit(" "), d)
    stay = shelf.put("stays", least.select(key(F.col("first.id"), F.col("first.digest")).alias(own)))
    shelf.clear("stays")
    found = docs.withColumn(own, key(F.col(doc_id), digest)).join(stay, own)
    rest = [F.col(text).isNull().alias("c"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text]]
    order = Window.partitionBy(own).orderBy(F.to_json(F.struct(*rest)))
    return found.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).select(*docs.columns)


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return components(docs).select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")
