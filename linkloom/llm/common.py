"""What the corpus operators share: word rules, slices of Arrow batches, shared folders, bounded samples."""

from __future__ import annotations

import gc
import tempfile
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java pattern of what separates words in the rules that take `[^\x20\x09-\x0D]+`.
SPACES = "[\\x20\\x09-\\x0D]+"
#: Bytes of text that an executor's Python handles at a time.
SLICE_BYTES = 2 << 20
#: Bytes that the driver's Python gives the JVM at a time.
PIECE_BYTES = 1 << 18


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[list[bytes | None]]:
    """UTF-8 texts of an Arrow array in lists of about `limit` bytes (one text at least); nulls stay None."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset + 1 : texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        start = ends[at - 1] if at else np.frombuffer(texts.buffers()[1], np.int64)[texts.offset]
        to = max(at + 1, int(np.searchsorted(ends, start + limit, "right")))
        yield texts.slice(at, to - at).to_pylist()
        at = to


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Where it is unset, a local run gets a temporary folder; on a cluster executors could not see one, so that
    this is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="linkloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fresh_folder(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder, deleted when the driver ends if not before (see `dropped`)."""
    path = f"{shared_folder(spark)}/{what}-{uuid4().hex}"
    place, store = _place(spark, path)
    store.mkdirs(place)
    store.deleteOnExit(place)
    return path


def put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Writes a file of the driver's to the shared folder, by whatever file system Spark has for it."""
    place, store = _place(spark, path)
    stream = store.create(place)
    for at in range(0, len(data), PIECE_BYTES):  # each goes as one line of text, of which the JVM makes several copies
        stream.write(data[at : at + PIECE_BYTES])
    stream.close()


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path in the shared folder, and the path there; for executors as for the driver."""
    return fs.FileSystem.from_uri(path)


def settled(df: DataFrame, what: str = "settled") -> DataFrame:
    """The rows of `df` as a table in the shared folder, with their lineage cut; they outlive lost executors."""
    return written(df, what)[0]


def spare_names(taken: Iterable[str], *names: str) -> list[str]:
    """`names`, each with underscores after it so that none is in `taken` or among the others, in whatever case."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's text, modulo `divisor`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def stratum_sizes(rows: DataFrame, stratum: str) -> dict:
    """Rows of each stratum, such as a label or language, of which there are few."""
    return dict(map(tuple, rows.groupBy(stratum).count().collect()))


def bounded_sample(rows: DataFrame, stratum: str, per_stratum: int, sizes: dict, key: str = "doc_id") -> DataFrame:
    """About `per_stratum` rows of each stratum, or all where there are fewer, chosen by a hash of `key`.

    The share that a stratum keeps follows from its size, so that any input gives a sample of bounded size:
    `per_stratum` rows are expected, and the count's deviation is its square root (for distinct keys).
    """
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(F.col(stratum).eqNullSafe(F.lit(value)), min(1.0, per_stratum / max(n, 1))).otherwise(share)
    return rows.where(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 30)) < share * float(1 << 30))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, features: Callable[[Column], Column]) -> tuple[pa.Table, dict[int, int]]:
    """(doc_id, features of the text, label) of a bounded sample of labelled documents in order, and the sizes of both classes.

    Labels are sampled first: the documents meet a table of bounded size, which is broadcast, and their texts are
    not shuffled. Repeated rows count once.
    """
    own = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    sizes = stratum_sizes(own, "label")
    some = F.broadcast(bounded_sample(own, "label", per_class, sizes))
    found = docs.select("doc_id", "text").join(some, "doc_id").select("doc_id", "label", features(F.col("text")).alias("x"))
    once = found.groupBy("doc_id", "label").agg(F.min("x").alias("x")).toArrow()
    return once.sort_by([("doc_id", "ascending"), ("label", "ascending")]), sizes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    """The rows of `df` as a Parquet table in the shared folder, and its path (see `dropped`)."""
    path = fresh_folder(df.sparkSession, what)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


class Shelf:
    """Tables of one job in the shared folder, by name."""

    def __init__(self, spark: SparkSession, job: str):
        self.spark, self.job, self.paths = spark, job, {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """The rows of `df` as a table; an older one of this name must not be read any more once this one is written."""
        rows, path = written(df, f"{self.job}-{name}")
        self.drop(name)
        self.paths[name] = path
        return rows

    def drop(self, *names: str, sweep: bool = False) -> None:
        """Deletes the tables of these names, if there are any; sweep: the shuffles of finished steps too."""
        dropped(self.spark, *[self.paths.pop(n) for n in names if n in self.paths], sweep=sweep)

    def clear(self, *but: str) -> None:
        """Deletes all tables but these, which a returned frame still reads; they go when the driver ends."""
        self.drop(*[n for n in self.paths if n not in but], sweep=True)


def dropped(spark: SparkSession, *paths: str, sweep: bool = True) -> None:
    """Deletes folders that `written` made, once nothing reads them any more; sweep: lets Spark clean the shuffles behind them.

    Spark deletes a shuffle's files when the driver has collected the objects that stand for it, which may be long
    after; on disks that hold several shuffles of the input this asks for it at once.
    """
    for path in paths:
        place, store = _place(spark, path)
        store.delete(place, True)
    if sweep:
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def word_counts(docs: DataFrame, find: Callable[[bytes | None], list], wanted: Callable[[str | bytes], bool], text: str = "text") -> DataFrame:
    """(word, n): how often `find` gives each word that is wanted over all texts; each slice of texts is counted before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(0)):
                own: Counter = Counter()
                for t in texts:
                    own.update(find(t))
                words = [w for w in own if wanted(w)]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([own[w] for w in words], pa.int64())], ["word", "n"])

    return docs.select(F.col(text)).mapInArrow(counted, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


#: Classes of counts for each doubling.
CLASSES = 16


def frequent(counts: DataFrame, most: int, least: int) -> list[tuple[bytes, int]]:
    """At most `most` of the commonest words that occur `least` times or more, the commonest first, ties by their bytes.

    Words are put into classes by the logarithm of their count, of which there are few, and those of the highest
    classes that hold `most` words together are gathered: no task sends more than it has of these.
    """
    shelf = Shelf(counts.sparkSession, "words")
    own = shelf.put("counts", counts.where(F.col("n") >= least).withColumn("class", F.floor(F.log2("n") * CLASSES).cast("int")))
    total, lowest = 0, None
    for r in own.groupBy("class").agg(F.count("*").alias("n")).orderBy(F.desc("class")).collect():
        total += r.n
        if total > most:
            break
        lowest = r["class"]
    top = own.where(F.col("class") >= lowest).select("word", "n").toArrow().to_pydict() if lowest is not None else {"word": [], "n": []}
    shelf.clear()
    return sorted(zip(top["word"], top["n"], strict=True), key=lambda x: (-x[1], x[0]))
