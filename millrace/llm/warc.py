"""WARC archives, written and read by an index.

Writing: every task streams its records, one gzip member each, to an archive of its own below the shared folder
and hands back one index row per record (file, offset, length, URL, digest). The file's name has the attempt's
number, so a lost executor's half-written archive is never named by the index. The index is a table.
Reading: the selected index rows are sorted by file and offset, neighbouring byte ranges are coalesced into one
read, and every record is parsed and its digest computed from the bytes found.

Reading tasks are dealt by the bytes to be read. Of records with equal payloads of at least `min_revisit` bytes the one with the largest identifier is the response
and the others are revisits of it; payloads are equal if SHA-1, SHA-256 and size are.

Defined results: a null payload is empty; a null url is written without a target; a null identifier is the smallest
and stays null; rows that repeat an identifier and payload are each written, with the same record type; an
empty table gives no archive and an empty result; further columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator
from math import ceil
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path, table, text_batches, written

INDEX_SCHEMA = "file string, offset bigint, length bigint, url string, digest string, payload_bytes bigint, record_type string, page_id bigint, refers_to bigint"
READ_SCHEMA = "page_id bigint, url string, record_type string, refers_to bigint, header_digest string, payload_digest string, payload_bytes bigint, payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAX_GAP, MAX_READ = 1 << 16, 4 << 20
TASK_LEAST, TASK_MOST = 1 << 20, 128 << 20  # archive bytes that a reading task is meant to have


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, date: str) -> bytes:
    name = lambda x: f"<urn:page:{'none' if x is None else x}>"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=';/?:@&=+$,#!*()~[]')}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one record, without its gzip member."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    number = lambda x: None if x is None or "none" in x else int(x.rpartition(":")[2].rstrip(">"))
    url = fields.get("WARC-Target-URI")
    return {"page_id": number(fields["WARC-Record-ID"]), "url": None if url is None else unquote(url), "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To")), "header_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "payload": payload}


def typed_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = 1000) -> DataFrame:
    """(page_id, url, payload, digest, payload_bytes, record_type, refers_to): what is to be written."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("bigint")}).withColumn("mark", F.when(F.col("payload_bytes") >= min_revisit, F.sha2("payload", 256)))
    keepers = rows.where("mark is not null").groupBy(F.col("digest").alias("k_digest"), F.col("mark").alias("k_mark"), F.col("payload_bytes").alias("k_bytes")).agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    keepers = written(keepers, "warc-keepers")  # a join behind an aggregation can't split a hot payload
    joined = rows.join(keepers, (F.col("digest") == F.col("k_digest")) & (F.col("mark") == F.col("k_mark")) & (F.col("payload_bytes") == F.col("k_bytes")), "left")
    revisit = F.col("n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    return joined.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "digest", "payload_bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("keep")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 4) -> DataFrame:
    """Write the archives and the index below `folder`; returns the index."""
    spark = records.sparkSession
    text_batches(spark)
    columns = ("page_id", "url", "payload", "digest", "payload_bytes", "record_type", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        context, out, at, name = TaskContext.get(), None, 0, ""
        try:
            for batch in batches:
                places = []
                for page, url, payload, digest, _, kind, refers in zip(*(batch.column(c) for c in columns), strict=True):
                    if out is None:
                        name = f"archives/part-{context.partitionId():05d}-{context.taskAttemptId()}.warc.gz"
                        store.create_dir(f"{root}/archives", recursive=True)
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    kind = kind.as_py()
                    record = record_bytes(page.as_py(), url.as_py(), payload.as_py() if kind == "response" else b"", digest.as_py(), kind, refers.as_py(), date)
                    member = gzip.compress(record, level, mtime=0)
                    out.write(member)
                    places.append((name, at, len(member)))
                    at += len(member)
                files, offsets, lengths = zip(*places, strict=True) if places else ((), (), ())
                same = [batch.column(c) for c in ("url", "digest", "payload_bytes", "record_type", "page_id", "refers_to")]
                yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), *same], names=[x.split()[0] for x in INDEX_SCHEMA.split(", ")])
        finally:
            if out is not None:
                out.close()

    records.select(*columns).mapInArrow(write, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def reading_tasks(selected: DataFrame) -> int:
    """How many tasks are to read the selected records: at most TASK_MOST bytes each, and of small reads as many as Spark shuffles to, if each has TASK_LEAST."""
    total = selected.agg(F.sum("length")).first()[0] or 0
    usual = int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, ceil(total / TASK_MOST), min(usual, ceil(total / TASK_LEAST)))


def read_records(selected: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that index rows name, by coalesced reads in file order."""
    names, kinds = zip(*(x.split() for x in READ_SCHEMA.split(", ")), strict=True)
    types = [{"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x] for x in kinds]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        name, source = None, None

        def fetch(run: list[tuple[int, int]]) -> pa.RecordBatch:
            start = run[0][0]
            data = source.read_at(run[-1][0] + run[-1][1] - start, start)
            rows = []
            for offset, length in run:
                row = parse_record(zlib.decompress(data[offset - start : offset - start + length], 31))
                full = row["record_type"] == "response"
                row |= {"payload_digest": hashlib.sha1(row["payload"]).hexdigest() if full else None, "payload_bytes": len(row["payload"]) if full else None, "payload": row["payload"] if full and with_payload else None}
                rows.append(row)
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, types, strict=True)], names=names)

        run: list[tuple[int, int]] = []
        for batch in batches:
            for file, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                end = run[-1][0] + run[-1][1] if run else 0
                if run and (file != name or offset - end > MAX_GAP or offset + length - run[0][0] > MAX_READ):
                    yield fetch(run)
                    run = []
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, store.open_input_file(f"{root}/{file}")
                run.append((offset, length))
        if run:
            yield fetch(run)
        if source is not None:
            source.close()

    ranges = selected.select("file", "offset", "length").repartitionByRange(reading_tasks(selected), "file", "offset").sortWithinPartitions("file", "offset")
    return ranges.mapInArrow(read, READ_SCHEMA)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Gives revisits the size and digest of the response they refer to; a revisit without its response keeps nulls."""
    responses = records.where("record_type = 'response'")
    revisits = records.where("record_type = 'revisit'")
    named = revisits.select(F.col("refers_to").alias("t_id"), F.col("header_digest").alias("t_digest")).distinct()
    targets = responses.select(F.col("page_id").alias("t_id"), F.col("payload_digest").alias("t_digest"), F.col("payload_bytes").alias("t_bytes")).join(named, ["t_id", "t_digest"], "left_semi").distinct()
    targets = written(targets, "warc-targets")  # a join behind an aggregation can't split a hot payload
    found = revisits.join(targets, (F.col("refers_to") == F.col("t_id")) & (F.col("header_digest") == F.col("t_digest")), "left")
    found = found.withColumns({"payload_digest": F.col("t_digest"), "payload_bytes": F.col("t_bytes")})
    return responses.unionByName(found.select(*responses.columns))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "warc")
    index = write_archives(typed_records(table(spark, sf_dir, "pages")), folder)
    read = read_records(index, folder, with_payload=False).drop("payload")
    path = f"{folder}/read"
    read.write.parquet(path)
    out = resolve_revisits(spark.read.schema(read.schema).parquet(path))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


ORACLE = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, url, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
             max(page_id) OVER (PARTITION BY h) AS keep FROM p)
SELECT page_id, payload_bytes, payload_digest, url,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM q
"""
