"""WARC archives with an index first, read back by coalesced byte ranges.

Every task that writes opens one archive of its own in the shared folder and
returns the place of each record: file, offset, length, url, digest. Spark
stores these rows as the index; archives of attempts that failed are in no
index row. Readers sort the selected rows by place, join neighbouring ranges and
fetch each range once.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikiloom.shared import new_path, stored

MIN_PAYLOAD = 1000
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture
#: Unread bytes that a range may span, and its size about.
GAP, RANGE_BYTES = 64 << 10, 4 << 20
#: Bytes of archives that a reading task fetches, about.
TASK_BYTES = 16 << 20
LEVEL = 3


def with_targets(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Adds ``refers_to``: the largest ``page_id`` with the same payload, null where that is the row's own.

    Payloads are compared by SHA-1 and length; the rows of a digest are
    combined before the shuffle.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    hashed = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
                          F.octet_length(html).cast("long").alias("payload_bytes"))
    large = hashed.where(F.col("payload_bytes") >= min_payload).select("digest", "payload_bytes", "page_id")
    shared = large.groupBy("digest", "payload_bytes").agg(F.max("page_id").alias("target"), F.count("*").alias("n"))
    copies = (large.where("page_id is not null").join(shared.where("n > 1").drop("n"), ["digest", "payload_bytes"])
              .where("page_id <> target").groupBy("page_id", "digest").agg(F.max("target").alias("refers_to")))
    return hashed.join(copies, ["page_id", "digest"], "left")


def record(kind: str, page_id, url: str | None, digest: str, payload: bytes, refers_to) -> bytes:
    """One WARC 1.1 record; a revisit has no payload of its own."""
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$&'()*+,/:;=?@[]~"))
    lines.append(f"WARC-Payload-Digest: sha1:{sha}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, body[:int(fields["Content-Length"])]


INDEX = ["file", "offset", "length", "url", "digest", "page_id"]


def write_archives(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write a record per row of ``pages`` below ``path``; returns the stored index.

    The index has ``file, offset, length, url, digest, page_id`` of each record,
    in ``path/index``; archives, gzipped record by record, are in
    ``path/archives``. ``path`` is any URI of a store that Arrow knows. A null
    ``html`` is an empty payload, null urls and ids are left out of the header.
    """
    archives = f"{path}/archives"
    id_field = T.StructField("page_id", pages.schema["page_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(archives)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(folder, recursive=True)
                out = store.open_output_stream(f"{folder}/{name}", compression=None)
                head = gzip.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:%s>\r\nWARC-Date: %s\r\n"
                                     b"Content-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
                                     % (name.encode(), DATE.encode()), LEVEL, mtime=0)
                out.write(head)
                at = len(head)
            offsets, lengths = [], []
            columns = [batch.column(c) for c in ("page_id", "url", "digest", "html", "refers_to")]
            for page_id, url, digest, html, target in zip(*columns):
                revisit = target.is_valid
                data = gzip.compress(record("revisit" if revisit else "response", page_id.as_py(), url.as_py(), digest.as_py(),
                                            b"" if revisit else html.as_py().encode(), target.as_py()), LEVEL, mtime=0)
                out.write(data)
                offsets.append(at)
                lengths.append(len(data))
                at += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(offsets), pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()),
                 batch.column("url"), batch.column("digest"), batch.column("page_id")], INDEX)
        if out is not None:
            out.close()

    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField("digest", T.StringType()), id_field])
    with_targets(pages, min_payload).mapInArrow(run, schema).write.parquet(f"{path}/index")
    return pages.sparkSession.read.schema(schema).parquet(f"{path}/index")


def coalesced(selected: DataFrame, gap: int = GAP, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``file, start, end, records``: one row per byte range that covers neighbouring records.

    A range ends where more than ``gap`` bytes are not wanted, and where the
    file passes a multiple of ``range_bytes``.
    """
    place = Window.partitionBy("file").orderBy("offset")
    apart = F.col("offset") - F.lag(F.col("offset") + F.col("length"), 1).over(place) > gap
    next_part = F.floor(F.col("offset") / range_bytes) > F.floor(F.lag("offset", 1).over(place) / range_bytes)
    starts = F.coalesce((apart | next_part).cast("long"), F.lit(0))
    return (selected.select("file", "offset", "length").withColumn("new", starts)
            .withColumn("run", F.sum("new").over(place))
            .groupBy("file", "run").agg(F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("end"),
                                        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"))
            .drop("run"))


def read_records(selected: DataFrame, path: str, id_type: str = "long", task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records of the selected index rows, read from the archives.

    ``page_id, url, record_type, payload_digest`` (hex SHA-1 of the header),
    ``refers_to`` and ``payload`` (empty for revisits). A record whose payload
    does not have its digest raises an error. A task fetches ``task_bytes`` about.
    """
    archives = f"{path}/archives"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(archives)
        for batch in batches:
            for name, start, end, records in zip(*(batch.column(c) for c in ("file", "start", "end", "records"))):
                with store.open_input_file(f"{folder}/{name.as_py()}") as file:
                    data = file.read_at(end.as_py() - start.as_py(), start.as_py())
                rows = []
                for place in records.as_py():
                    low = place["offset"] - start.as_py()
                    fields, payload = parse(gzip.decompress(data[low:low + place["length"]]))
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    kind, target, url = fields["WARC-Type"], fields.get("WARC-Refers-To"), fields.get("WARC-Target-URI")
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{name} at {place['offset']}: payload does not have its digest")
                    rows.append((fields["WARC-Record-ID"][10:-1] or None, unquote(url) if url is not None else None, kind,
                                 digest, target and target[10:-1], payload))
                columns = list(zip(*rows))
                types = [pa.string()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                                 ["page_id", "url", "record_type", "payload_digest", "refers_to", "payload"])

    schema = "page_id string, url string, record_type string, payload_digest string, refers_to string, payload binary"
    ranges = stored(coalesced(selected), "ranges")
    total = ranges.agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0))).first()[0]
    # A number that is given is not lowered by the size of these small rows.
    dealt = ranges.repartition(-(-total // task_bytes) or 1, "file", "start")
    return dealt.mapInArrow(run, schema).withColumns(
        {c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def round_trip(pages: DataFrame, path: str | None = None, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``, read back from archives written at ``path``.

    Of equal payloads of at least ``min_payload`` bytes the largest ``page_id``
    is the response; the others are revisits and take the size of the payload
    from the record they refer to. Rows that share that id are all responses; so
    are rows without id. Repeated rows are records each. An empty table gives
    no rows.
    """
    path = path or new_path(pages.sparkSession, "warc")
    path = path if "://" in path or path.startswith("file:") else f"file://{path}"
    index = write_archives(pages, path, min_payload)
    read = read_records(index, path, pages.schema["page_id"].dataType.simpleString())
    return sized(stored(read.select("page_id", "record_type", "payload_digest", "refers_to",
                                    F.octet_length("payload").cast("long").alias("_bytes")), "records"))


def sized(read: DataFrame) -> DataFrame:
    """Gives revisits the payload size of the response they refer to."""
    revisits = read.where("record_type = 'revisit'")
    wanted = revisits.select("refers_to", "payload_digest").distinct().select(F.col("refers_to").alias("page_id"), "payload_digest")
    targets = (read.where("record_type = 'response'").join(wanted, ["page_id", "payload_digest"])
               .groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("_bytes").alias("payload_bytes")))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    full = read.where("record_type = 'response'").withColumn("payload_bytes", F.col("_bytes")).select(columns)
    return full.unionByName(revisits.join(targets, ["refers_to", "payload_digest"], "left").select(columns))
