"""WARC archives: an index first, then coalesced reads of byte ranges.

Writing: each task writes the records of its pages to archives of its own in the shared folder, one gzip member
for each record, and returns the index: archive, offset, length, url and digest of each record. An archive's
name is new with each attempt of a task, so that one which is tried again leaves at most a file that no index
names. Of records with equal payloads, that with the largest page_id is the response, and others revisit it.

Reading: the selected rows of the index are dealt out by archive and stretch of it, sorted by offset, and
ranges that lie near each other are read at once; each record is then parsed on its own. The reader takes page,
payload size and digest from the records, and checks each response's payload against its digest.

Files are opened with pyarrow's filesystems, by the shared folder's scheme.

Edge cases: a null html is an empty payload, and a long one is written whole; a null url is empty, and line ends
in a url are escaped; a page whose id is null revisits an equal one that has an id, and is a response without
one; rows with the same id and payload are all responses (or all revisits); ids are integers or strings (of which
the last in their order is the largest); an empty table gives an empty index and no records. Other columns of
the pages are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from linkloom.llm.common import dropped, fresh_folder, opened, settled, table, written

LEAST_BYTES = 0
ROLL_BYTES = 1 << 30
#: Records of one stretch of an archive are read by one task.
STRETCH_BYTES = 16 << 20
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
_INDEX = "page_id {id}, archive string, offset bigint, length bigint, url string, digest string, record_type string"
_RECORD = "page_id {id}, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to {id}, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(page_id: int | str) -> str:
    return quote(str(page_id), safe="/:")


def _record_id(page_id: int | str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | str | None, url: str | None, payload: bytes, refers_to: int | str | None, date: str = DATE) -> bytes:
    """One record; a revisit has the head of the response only."""
    digest = base32_sha1(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page_id, digest)), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if page_id is not None:
        fields.append(("X-Page-ID", _header(page_id)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", _record_id(refers_to, digest)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page", _header(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def gzipped(raw: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def parsed(member: bytes, numbered: bool = True) -> dict:
    """What a gzip member of one record says; numbered: ids are integers."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]}")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    own = lambda k: None if k not in fields else int(fields[k]) if numbered else unquote(fields[k])
    return {"page_id": own("X-Page-ID"), "url": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": own("X-Refers-To-Page"), "payload": payload if kind == "response" else None}


def _writer(folder: str, roll: int, numbered: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, archive, offset = None, "", 0
        for batch in batches:
            index: dict[str, list] = {k: [] for k in ("page_id", "archive", "offset", "length", "url", "digest", "record_type")}
            columns = [batch.column(k).to_pylist() for k in ("page_id", "url", "html", "refers_to")]
            for page_id, url, html, refers_to in zip(*columns, strict=True):
                if out is None or offset >= roll:
                    if out is not None:
                        out.close()
                    archive, offset = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    place, path = opened(archive)
                    place.create_dir(path.rpartition("/")[0], recursive=True)
                    out = place.open_output_stream(path, compression=None)
                payload = (html or "").encode("utf-8", "replace")
                member = gzipped(record(page_id, url, payload, refers_to))
                out.write(member)
                row = (page_id, archive, offset, len(member), url, base32_sha1(payload), "response" if refers_to is None else "revisit")
                for k, v in zip(index, row, strict=True):
                    index[k].append(v)
                offset += len(member)
            kinds = {"page_id": pa.int64() if numbered else pa.string(), "offset": pa.int64(), "length": pa.int64()}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.string())) for k, v in index.items()})
        if out is not None:
            out.close()

    return write


def ranges(spans: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int, list[int]]]:
    """Reads (start, end, numbers of the spans in it) for spans (offset, length) sorted by offset."""
    out: list[tuple[int, int, list[int]]] = []
    for k, (offset, length) in enumerate(spans):
        if out and offset - out[-1][1] <= gap and offset + length - out[-1][0] <= most:
            out[-1] = (out[-1][0], max(out[-1][1], offset + length), [*out[-1][2], k])
        else:
            out.append((offset, offset + length, [k]))
    return out


def _reader(with_payload: bool, numbered: bool):
    own = pa.int64() if numbered else pa.string()
    kinds = [("page_id", own), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", own), ("payload", pa.binary())]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(k).to_pylist() for k in ("archive", "offset", "length")), strict=True))
            at = 0
            while at < len(rows):
                to = at
                while to < len(rows) and rows[to][0] == rows[at][0]:
                    to += 1
                place, path = opened(rows[at][0])
                with place.open_input_file(path) as f:
                    for start, end, numbers in ranges([(o, n) for _, o, n in rows[at:to]]):
                        raw = f.read_at(end - start, start)
                        found = [parsed(raw[o - start : o - start + n], numbered) for _, o, n in (rows[at + k] for k in numbers)]
                        yield pa.RecordBatch.from_pydict({k: pa.array([x[k] if k != "payload" or with_payload else None for x in found], kind) for k, kind in kinds})
                at = to

    return read


def id_type(rows: DataFrame, column: str = "page_id") -> str:
    """The type of ids in archives: bigint for those of any integer type, else string."""
    return "bigint" if isinstance(rows.schema[column].dataType, IntegralType) else "string"


def revisited(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """`pages` (page_id, url, html) with refers_to: the page that holds the equal payload, null for responses."""
    own = pages.select(F.col("page_id").cast(id_type(pages)).alias("page_id"), "url", "html").withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    size = F.octet_length(F.coalesce("html", F.lit("")))
    large = own.where(size >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    last = settled(large.where("n > 1 and last is not null").drop("n"), "warc-last")
    other = ~F.col("page_id").eqNullSafe(F.col("last"))
    return own.join(last, "digest", "left").select("page_id", "url", "html", F.when(F.col("last").isNotNull() & other, F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, roll_bytes: int = ROLL_BYTES) -> tuple[DataFrame, str]:
    """Writes archives below `folder`; the index of all records and its path in the shared folder."""
    kind = id_type(pages)
    return written(revisited(pages, least_bytes).mapInArrow(_writer(folder, roll_bytes, kind == "bigint"), _INDEX.format(id=kind)), "warc-index")


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that the rows of `index` name."""
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, total // STRETCH_BYTES + 1)  # by bytes of the archives, not of the index
    stretch, kind = F.floor(F.col("offset") / STRETCH_BYTES), id_type(index)
    dealt = index.select("archive", "offset", "length").withColumn("stretch", stretch).repartition(int(tasks), "archive", "stretch").sortWithinPartitions("archive", "offset")
    return dealt.drop("stretch").mapInArrow(_reader(with_payload, kind == "bigint"), _RECORD.format(id=kind))


def op10_warc(spark, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "warc")
    index, path = write_archives(table(spark, sf_dir, "pages"), folder)
    records = settled(read_records(index, with_payload=False).drop("url", "payload"))
    dropped(spark, folder, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages
), g AS (SELECT t, max(page_id) AS m FROM p GROUP BY t
), d AS (
  SELECT page_id, strlen(p.t)::BIGINT AS payload_bytes, h, m,
         list_transform(range(8), lambda k: CAST('0x' || substr(h, 5 * k + 1, 5) AS INTEGER)) AS v
  FROM p JOIN g ON p.t = g.t
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(v, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 15) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 10) & 31) + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 5) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = m THEN NULL ELSE m END AS refers_to
FROM d
"""
