"""WARC archives in which repeated payloads are revisit records.

Only headers (page_id, digest, length) are shuffled to find the original of each payload; the
payloads themselves move once, to meet their page's verdict, and are written by many tasks.
Reading back, revisit records find their originals by the record id they refer to, again
among headers alone.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import folder, input_table, materialize, open_folder, slices, spread_name, table

LEAST_BYTES = 1000
#: Ways in which the pages of one payload are dealt out when they look up their original.
SALT = 16
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the WARC format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, payload_digest: str, nth: int = 1) -> str:
    """The same for every attempt to write the record; nth: which of the rows of one page_id and payload."""
    name = f"{page_id}/{payload_digest}" if nth == 1 else f"{page_id}/{payload_digest}/{nth}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None, revisit: bool,
           date: str = DATE, nth: int = 1) -> bytes:
    """One record, compressed as a gzip member of its own.  A revisit refers to its original page's first row."""
    import gzip

    uri = "".join(" " if c < " " else c for c in url) if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, nth)),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(original, digest)), ("WARC-Truncated", "length")]
    text = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return gzip.compress(VERSION + text + b"\r\n" + block + b"\r\n\r\n", compresslevel=1, mtime=0)


def records(source, chunk: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record; holds one record at a time."""
    inflate, out, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or source.read(chunk)
        rest = b""
        if not data:
            return
        out.append(inflate.decompress(data))
        if inflate.eof:
            head, _, block = b"".join(out).partition(b"\r\n\r\n")
            if not head.startswith(VERSION):
                raise ValueError("not a WARC record")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            fields = {k.lower(): v for k, v in fields.items()}
            yield fields, block[: int(fields["content-length"])]
            rest, inflate, out = inflate.unused_data, zlib.decompressobj(31), []


def with_digest(pages: DataFrame) -> DataFrame:
    """page_id, page_key, url, payload (null html: empty) and its bytes and SHA-1."""
    rows = input_table(pages, page_id="long", url="string", html="string")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    # A key without null, so that joining and numbering need the same distribution.
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page_key")
    return rows.select("page_id", key, "url", payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))


def verdicts(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_key, payload_digest, original of the pages whose payload other pages have too.

    original: the largest page_id with the payload.  Pages of one payload look it up in SALT
    shares, so a payload that a third of all pages have is no single task's.
    """
    long = headers.filter(F.col("payload_bytes") >= least_bytes)
    groups = (long.groupBy("payload_digest", "payload_bytes")
              .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))))
    salted = long.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALT)).cast("int"))
    return (salted.join(groups, ["payload_digest", "payload_bytes", "salt"])
            .select("page_key", "payload_digest", "original", F.lit(True).alias("shared")).distinct())


def write_archives(pages: DataFrame, out: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes a record for every page to archives below out; returns the manifest (path, n_records).

    Of the pages with equal payloads of at least least_bytes, the one with the largest
    page_id is a response and the others are revisits of it; a page_id that comes twice with one
    payload has one response (the first by url) and further rows revisit it.  Null
    page_ids count as smaller than all others.  An empty table gives no archives.
    """
    rows = with_digest(pages)
    found = verdicts(rows.select("page_id", "page_key", "payload_bytes", "payload_digest"), least_bytes)
    joined = rows.join(found, ["page_key", "payload_digest"], "left").withColumn("shared", F.col("shared").isNotNull())
    # Rows of one page_id and payload have records of their own; of the original's, the first is the response.
    is_original = F.col("shared") & F.col("page_id").eqNullSafe(F.col("original"))
    judged = joined.withColumn("nth", F.row_number().over(Window.partitionBy("page_key", "payload_digest").orderBy("url")))
    judged = judged.withColumn("revisit", F.col("shared") & (~is_original | (F.col("nth") > 1)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = sink = None
        path, n = "", 0
        for batch in slices(batches, "payload"):
            if sink is None:
                system, where = open_folder(out)
                path = f"{where}/{spread_name('pages', '.warc.gz')}"
                sink = system.open_output_stream(path, compression=None)
            for r in batch.to_pylist():
                sink.write(record(r["page_id"], r["url"], r["payload"], r["payload_digest"], r["original"], r["revisit"], nth=r["nth"]))
            n += batch.num_rows
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [n]})

    return materialize(judged.mapInArrow(write, "path string, n_records long"), "warc-manifest")


def read_archives(manifest: DataFrame, out: str) -> DataFrame:
    """Headers of all records: page_id, record_id, refers_to_record, record_type, payload_bytes, payload_digest.

    Of a response, bytes and digest are those of the payload read, which must be as the record says.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(out)
        for path in (x for batch in batches for x in batch.column("path").to_pylist()):
            rows = []
            with system.open_input_stream(path, compression=None) as source:
                for head, block in records(source):
                    payload, said = block.partition(b"\r\n\r\n")[2], head["warc-payload-digest"].removeprefix("sha1:")
                    revisit, page = head["warc-type"] == "revisit", head.get("x-page-id")
                    if not revisit and hashlib.sha1(payload).hexdigest() != said:
                        raise ValueError(f"{head['warc-record-id']}: the payload is not as recorded")
                    rows.append((None if page is None else int(page), head["warc-record-id"], head.get("warc-refers-to"),
                                 head["warc-type"], None if revisit else len(payload), said))
                    if len(rows) >= 4096:
                        yield of(rows)
                        rows = []
            if rows:
                yield of(rows)

    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string())
    names = ["page_id", "record_id", "refers_to_record", "record_type", "payload_bytes", "payload_digest"]

    def of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)

    parts = manifest.sparkSession.sparkContext.defaultParallelism * 4
    return manifest.select("path").repartition(parts, "path").mapInArrow(
        read, "page_id long, record_id string, refers_to_record string, record_type string, payload_bytes long, payload_digest string")


def resolve(headers: DataFrame) -> DataFrame:
    """Joins revisit records to the responses they refer to, for their page_id and payload length."""
    revisits = headers.filter("record_type = 'revisit'").withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALT)).cast("int"))
    wanted = revisits.select(F.col("refers_to_record").alias("wanted")).distinct()
    originals = (headers.filter("record_type = 'response'").join(wanted, F.col("record_id") == F.col("wanted"), "left_semi")
                 .select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full"),
                         F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    solved = revisits.join(originals, ["refers_to_record", "salt"], "left").withColumn("payload_bytes", F.col("full"))
    responses = headers.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    return responses.select(*columns).unionByName(solved.select(*columns))


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from the archives read back."""
    out = folder(spark, "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), out)
    return resolve(materialize(read_archives(manifest, out), "warc-headers"))


OP9_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS payload_digest FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id <> original THEN original END AS refers_to
FROM g
"""
