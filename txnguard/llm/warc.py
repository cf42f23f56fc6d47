"""Operator 2: WARC archives, with a normaliser from one gzip stream to one member per record."""

from __future__ import annotations

import hashlib
import io
import json
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.session import materialize, scratch_path

#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"
RECORD_END = EOL + EOL

#: Payloads below this size are never revisited.
MIN_REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"


def _header(name: str, value: Column) -> Column:
    """One header line, or nothing for a null value; control characters are blanked out of the value."""
    line = F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\x00-\x1F\x7F]", " "), F.lit(EOL))
    return F.coalesce(line, F.lit(""))


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (``page_id, url, html``) with ``payload, size, digest, refers_to``.

    Equal payloads are found by digest: an aggregation over digests alone, of
    which only repeated ones are joined back, so a payload with a third of all
    pages is summed before the shuffle and its join can be split.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    digested = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"size": F.octet_length("payload").cast("long"), "digest": F.sha2(F.col("payload").cast("binary"), 256)}
    )
    large = digested.filter((F.col("size") >= min_bytes) & F.col("page_id").isNotNull())
    first = large.groupBy(F.col("digest").alias("_digest")).agg(F.min("page_id").alias("_first"), F.count("*").alias("_times"))
    first = materialize(first.filter("_times > 1").drop("_times"), "repeated")
    other = F.col("page_id").isNotNull() & (F.col("_first") != F.col("page_id"))
    return digested.join(first, digested.digest == first._digest, "left").select(
        "page_id", "url", "payload", "size", "digest", F.when(other, F.col("_first")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES, date: str = DATE) -> None:
    """Write one WARC record per row of ``pages`` below ``folder``, each file a single gzip stream.

    Spark's text writer does it: a record is a row, the end of a record is the
    line end, and the commit protocol leaves whole files only.
    """
    marked = mark_revisits(pages, min_bytes)
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
        F.col("size").cast("string"),
        F.lit(RECORD_END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    record = F.concat(
        F.lit(VERSION + EOL),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(f">{EOL}")),
        _header("WARC-Target-URI", F.col("url")),
        F.lit(f"WARC-Date: {date}{EOL}"),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _header("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.lit(f"Content-Type: application/http; msgtype=response{EOL}"),
        _header("Content-Length", F.octet_length(block)),
        F.lit(EOL),
        block,
    )
    writer = marked.select(record.alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip")
    writer.text(folder)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a Hadoop-style URI."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


class _Inflated(io.RawIOBase):
    """The content of a gzip file of one or more members, inflated as it is read."""

    def __init__(self, source, chunk: int = 1 << 18):
        self._source, self._chunk = source, chunk
        self._inflate, self._packed, self._plain = zlib.decompressobj(31), b"", memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self._plain:
            if self._inflate.eof:
                self._packed, self._inflate = self._inflate.unused_data, zlib.decompressobj(31)
            if not self._packed:
                self._packed = self._source.read(self._chunk)
                if not self._packed:
                    return 0
            self._plain = memoryview(self._inflate.decompress(self._packed, 1 << 20))
            self._packed = self._inflate.unconsumed_tail
        count = min(len(target), len(self._plain))
        target[:count] = self._plain[:count]
        self._plain = self._plain[count:]
        return count


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Headers, raw header bytes and block of each record of an inflated archive, one record in memory at a time."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line == b"\r\n":
            continue
        raw, headers = [line], {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            raw.append(line)
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) < int(headers["content-length"]):
            raise ValueError(f"record {headers.get('warc-record-id')} is cut off")
        yield headers, b"".join(raw) + b"\r\n", block


def _normalise_file(path: str, folder: str) -> tuple[str, str, int]:
    """Rewrite one archive; both results appear under their names only when they are whole."""
    system, name = _open(path)
    base = f"{folder}/{os.path.basename(name).split('.')[0]}"
    target, place = _open(base)
    own = uuid.uuid4().hex
    entries, offset = [], 0
    with system.open_input_stream(name, compression=None) as source, target.open_output_stream(
        f"{place}.{own}.tmp", compression=None
    ) as out:
        for headers, head, block in read_records(io.BufferedReader(_Inflated(source), 1 << 20)):
            pack = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = pack.compress(head + block + b"\r\n\r\n") + pack.flush()
            out.write(member)
            entries.append({"id": headers["warc-record-id"], "type": headers["warc-type"], "at": offset, "bytes": len(member)})
            offset += len(member)
    with target.open_output_stream(f"{place}.{own}.idx.tmp", compression=None) as out:
        out.write("".join(json.dumps(e) + "\n" for e in entries).encode())
    target.move(f"{place}.{own}.tmp", f"{place}.warc.gz")
    target.move(f"{place}.{own}.idx.tmp", f"{place}.idx.jsonl")
    return f"{base}.warc.gz", f"{base}.idx.jsonl", len(entries)


def normalise_archives(spark: SparkSession, source: str, folder: str) -> DataFrame:
    """``archive, index, records`` of every gzip file below ``source``, rewritten below ``folder``.

    A task inflates a whole-file stream once, front to back, writes every
    record as a gzip member of its own and lists id, type, offset and length in
    a sidecar file of JSON lines. A task that is run again writes the same
    bytes and replaces nothing but equal files. ``folder`` must be shared by
    all executors and open to pyarrow's file systems.
    """
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    target, place = _open(folder)
    target.create_dir(place, recursive=True)

    def rewrite(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                archive, index, records = _normalise_file(path, folder)
                yield pa.RecordBatch.from_pydict({"archive": [archive], "index": [index], "records": pa.array([records], pa.int64())})

    return materialize(names.mapInArrow(rewrite, "archive string, index string, records long"), "archives")


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of normalised archives, each inflated by itself from its indexed place.

    ``record_id, uri, payload_bytes, payload_digest, record_type, refers_to``
    and, if asked for, ``payload`` (null for revisits). Size and digest of a
    response are measured on what was read and must equal its headers; those of
    a revisit come from its headers.
    """

    def read(batches):
        for batch in batches:
            for archive, index in zip(batch.column("archive").to_pylist(), batch.column("index").to_pylist()):
                system, place = _open(archive)
                index_system, index_place = _open(index)
                rows: list[tuple] = []
                with system.open_input_file(place) as data, index_system.open_input_stream(index_place) as listed:
                    for line in io.BufferedReader(listed):
                        rows.append(_read_record(data, json.loads(line), with_payload))
                        if len(rows) == 256:
                            yield _batch(rows, with_payload)
                            rows = []
                if rows:
                    yield _batch(rows, with_payload)

    kind = ", payload binary" if with_payload else ""
    names = "record_id string, uri string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    return archives.select("archive", "index").mapInArrow(read, names + kind)


def _batch(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    names = ["record_id", "uri", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    count = 7 if with_payload else 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows))[:count], kinds)], names[:count])


def _read_record(data, entry: dict, with_payload: bool) -> tuple:
    data.seek(entry["at"])
    member = zlib.decompress(data.read(entry["bytes"]), 31)
    headers, _, block = next(read_records(io.BytesIO(member)))
    if headers["warc-record-id"] != entry["id"]:
        raise ValueError(f"the index is wrong at {entry['at']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    if entry["type"] == "response":
        measured = (len(payload), hashlib.sha256(payload).hexdigest())
        if measured != (size, digest):
            raise ValueError(f"record {entry['id']} is damaged")
    number = lambda urn: urn and (urn.removeprefix("<urn:page:").removesuffix(">") or None)
    return (
        number(entry["id"]), headers.get("warc-target-uri"), size, digest, entry["type"],
        number(headers.get("warc-refers-to")), payload if entry["type"] == "response" and with_payload else None,
    )


def archive_round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` as archives, normalise them, read them back: ``page_id, uri`` and the record's fields.

    Null html is an empty payload; a null url leaves the target out; a null
    page id is written without one, is always a response and never referred to.
    Repeated rows with the least id of their payload are all responses. Control
    characters in urls become blanks. Other columns are not read. An empty
    table gives no rows.
    """
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType
    slim = pages.select("page_id", "url", "html")
    written, folder = scratch_path(spark, "warc"), scratch_path(spark, "warc-members")
    write_archives(slim, written, min_bytes)
    rows = read_archives(normalise_archives(spark, written, folder))
    return rows.select(
        F.col("record_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "uri",
    )


def warc_sql(min_bytes: int = MIN_REVISIT_BYTES) -> str:
    """DuckDB SQL of the query's result."""
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= {min_bytes} GROUP BY payload_digest),
r AS (SELECT p.*, CASE WHEN first <> page_id THEN first END AS refers_to FROM p LEFT JOIN f USING (payload_digest))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM r"""
