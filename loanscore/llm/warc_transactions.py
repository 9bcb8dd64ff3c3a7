"""WARC archives: writing, reading back, and transaction assembly.

Writing. Each capture becomes a request, a response (or revisit) and a
metadata record; request and metadata point to the response by
``WARC-Concurrent-To``. Payloads that occur more than once are written once:
the capture with the smallest id is the response, the others are revisit
records that refer to it. Records are built in DataFrame functions and
written by Spark's text sink with the record end as line separator, so every
part file is an archive of whole records and a lost task is simply written
again. ``FILE_BYTES`` bounds the size of a file before compression, since a
reader takes a whole file: every task adds up its records' bytes as it goes
and a record that would pass the bound starts the next file (a larger record
stands alone).

Reading. Files are read by Spark's binary source, so any store that Spark
reads will do; records are cut by their ``Content-Length`` alone, whatever
their content.

Assembly. Request and metadata records are joined to the response or revisit
that they are concurrent to; every capture is one nested row.

Defined results: a null payload is empty; captures with equal payloads and
equal smallest ids (repeated rows) are all responses; a null id ranks last
and a null URL is written as the empty target; payloads shorter than
``min_bytes`` are never revisits; empty tables give no records and no
captures. Records that are concurrent to no capture, or to one that is not in
the archives, are left out. Only the named columns are read.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscore.llm.common import Written

FILE_BYTES = 16_000_000
PIECE_BYTES = 65_536  # of a cut archive, unzipped at once
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# The digits of base 32 and those that conv() writes.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

RECORD = (
    "file string, offset long, warc_type string, record_id string, concurrent_to string, refers_to string,"
    " target_uri string, warc_date string, payload_digest string, content_type string, block binary"
)


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base-32 SHA-1 of a binary or string column."""
    digest = F.sha1(data)
    quads = [F.lpad(F.conv(F.substr(digest, F.lit(k * 5 + 1), F.lit(5)), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*quads), CONV32, BASE32)


def keyed_captures(captures: DataFrame) -> DataFrame:
    """(capture_id, url, payload) without nulls in url and payload, with payload_bytes and payload_digest."""
    return captures.select(
        "capture_id",
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce(F.col("payload").cast("string"), F.lit("")).alias("payload"),
    ).select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), sha1_base32(F.col("payload")).alias("payload_digest"))


def shared_payloads(keyed: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(digest, bytes, first) of every payload that occurs more than once: a partial aggregate over digests only."""
    same = keyed.where(F.col("payload_bytes") >= min_bytes).groupBy(F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("bytes"))
    return same.agg(F.min("capture_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "bytes", "first")


def mark_revisits(keyed: DataFrame, shared: DataFrame) -> DataFrame:
    """The captures with refers_to (null for a response).

    Give ``shared`` as a written table: its size is known then, so Spark
    broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and else joins two
    plain shuffles, of which it splits the captures of a frequent payload.
    """
    same = (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") == F.col("bytes"))
    later = F.col("capture_id").isNull() | (F.col("capture_id") > F.col("first"))
    return keyed.join(shared, same, "left").select(
        "capture_id", "url", "payload", "payload_bytes", "payload_digest", F.when(later, F.col("first")).alias("refers_to")
    )


def _uuid_of(kind: str, seed: Column) -> Column:
    """A record id by kind and capture."""
    digest = F.md5(F.concat(F.lit(kind + ":"), seed))
    parts = [F.substr(digest, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.lit("WARC/1.1\r\n")]
    for name, value in headers:
        lines.append(F.coalesce(F.concat(F.lit(name + ": "), value, F.lit("\r\n")), F.lit("")))
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(*lines, length, block)


def _one_line(value: Column) -> Column:
    """Header values hold no line ends."""
    return F.regexp_replace(value, r"[\r\n]+", " ")


def records(marked: DataFrame, warc_date: str) -> DataFrame:
    """``record`` (text without the record end): three records for each capture."""
    seed = F.concat_ws("|", F.coalesce(F.col("capture_id").cast("string"), F.lit("")), F.col("row_key"))
    rows = marked.withColumn("row_key", F.uuid()).select("*", seed.alias("seed"))
    response, date, uri = _uuid_of("response", F.col("seed")), F.lit(warc_date), _one_line(F.col("url"))
    revisit = F.col("refers_to").isNotNull()
    ident = F.coalesce(F.col("capture_id").cast("string"), F.lit(""))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    main = _record(
        [
            ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            ("WARC-Record-ID", response),
            ("WARC-Date", date),
            ("WARC-Target-URI", uri),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            ("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
            ("WARC-Refers-To-Capture", F.col("refers_to").cast("string")),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))),
    )
    request = _record(
        [
            ("WARC-Type", F.lit("request")),
            ("WARC-Record-ID", _uuid_of("request", F.col("seed"))),
            ("WARC-Date", date),
            ("WARC-Target-URI", uri),
            ("WARC-Concurrent-To", response),
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(
            F.lit("GET "),
            F.coalesce(F.nullif(F.regexp_extract(uri, r"^[^:/?#]*://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/")),
            F.lit(" HTTP/1.1\r\nHost: "),
            F.regexp_extract(uri, r"://([^/?#]*)", 1),
            F.lit("\r\n\r\n"),
        ),
    )
    metadata = _record(
        [
            ("WARC-Type", F.lit("metadata")),
            ("WARC-Record-ID", _uuid_of("metadata", F.col("seed"))),
            ("WARC-Date", date),
            ("WARC-Target-URI", uri),
            ("WARC-Concurrent-To", response),
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(F.lit("captureId: "), ident, F.lit("\r\npayloadBytes: "), F.col("payload_bytes").cast("string"), F.lit("\r\n")),
    )
    return rows.select(F.explode(F.array(request, main, metadata)).alias("record"))


def _file_numbers(limit: int):
    """A Spark function bytes of a record -> number of the record's file within its task."""

    @F.arrow_udf("int")
    def numbers(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        number = size = 0
        for batch in batches:
            found = []
            for length in batch.to_pylist():
                if size and size + length > limit:
                    number, size = number + 1, 0
                size += length
                found.append(number)
            yield pa.array(found, pa.int32())

    return numbers.asNondeterministic()


def write_archives(captures: DataFrame, path: str, warc_date: str = "2026-01-01T00:00:00Z", min_bytes: int = 0, bytes_per_file: int = FILE_BYTES) -> None:
    """Writes (capture_id, url, payload) as gzipped archives in folders by file number under ``path``."""
    keyed = keyed_captures(captures)
    shared = Written(shared_payloads(keyed, min_bytes), "shared_payloads")
    lines = records(mark_revisits(keyed, shared.df), warc_date)
    size = F.octet_length("record").cast("long") + len(RECORD_END)
    dealt = lines.select("record", _file_numbers(bytes_per_file)(size).alias("file"))
    dealt.write.partitionBy("file").options(lineSep=RECORD_END, compression="gzip").text(path)
    shared.drop()


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers in lower case, block) of an archive's records, gzipped as a whole or by record."""
    if data[:2] == b"\x1f\x8b":
        data = _unzipped(data)
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers.get("content-length", "0"))
        yield at, headers, data[end + 4 : end + 4 + length]
        at = end + 4 + length
        while data[at : at + 2] == b"\r\n":
            at += 2


def _unzipped(data: bytes) -> bytes:
    try:
        return gzip.decompress(data)
    except EOFError:  # cut off: what is whole is read, member by member
        parts, at = [], 0
        while at < len(data):
            member = zlib.decompressobj(31)
            while at < len(data) and not member.eof:
                parts.append(member.decompress(data[at : at + PIECE_BYTES]))
                at = min(at + PIECE_BYTES, len(data)) - len(member.unused_data)
            while data[at : at + 1] == b"\0":  # padding
                at += 1
        return b"".join(parts)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``, one row each (``RECORD``)."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = ["warc-type", "warc-record-id", "warc-concurrent-to", "warc-refers-to-capture", "warc-target-uri", "warc-date", "warc-payload-digest", "content-type"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                rows: list[tuple] = []
                size = 0
                for offset, headers, block in parse_records(content.as_py()):
                    rows.append((file.as_py(), offset, *[headers.get(h) for h in schema], block))
                    size += len(block)
                    if size >= 4_000_000:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return files.mapInArrow(cut, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in RECORD.split(", ")]
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 8, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def payload_of(block: Column) -> Column:
    """What follows the HTTP head of a record's block."""
    # Compared byte by byte, whatever they say in UTF-8; without an end the head is the whole block.
    head = F.substring_index(block.cast("string"), "\r\n\r\n", 1)
    return F.coalesce(F.substr(block, F.octet_length(head) + F.lit(5)), F.lit(b""))


def field_of(block: Column, name: str) -> Column:
    """A field of a block of type application/warc-fields."""
    return F.regexp_extract(F.decode(block, "UTF-8"), rf"(?m)^{name}: ([^\r\n]*)", 1)


def assemble(found: DataFrame, main: list[Column], request: list[Column], metadata: list[Column]) -> DataFrame:
    """One nested row for each capture: record_id and the structs main, request and metadata.

    ``main``, ``request`` and ``metadata`` say what to keep of each kind of
    record; it is cut out before the records are shuffled by their capture.
    Several requests or metadata records of a capture are kept as a list in
    the order of their ids.
    """
    is_main = F.col("warc_type").isin("response", "revisit")
    rows = found.where(F.col("warc_type").isin("response", "revisit", "request", "metadata")).select(
        F.when(is_main, F.col("record_id")).otherwise(F.col("concurrent_to")).alias("capture"),
        F.when(is_main, F.struct(F.col("warc_type"), F.col("record_id"), F.col("target_uri"), *main)).alias("main"),
        F.when(F.col("warc_type") == "request", F.struct(F.col("record_id"), *request)).alias("request"),
        F.when(F.col("warc_type") == "metadata", F.struct(F.col("record_id"), *metadata)).alias("metadata"),
    )
    joined = rows.where("capture IS NOT NULL").groupBy("capture").agg(
        F.first("main", ignorenulls=True).alias("main"),
        F.array_sort(F.collect_list("request")).alias("requests"),
        F.array_sort(F.collect_list("metadata")).alias("metadata"),
    )
    return joined.where("main IS NOT NULL").withColumnRenamed("capture", "record_id")
