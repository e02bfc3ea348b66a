"""Web archives with revisit resolution (operator 10).

1. Headers: one pass over the pages takes the SHA-1 digest and size of each
   payload; only these headers are shuffled, by digest. Of records with equal
   payloads (of at least ``min_bytes``) the one with the largest page id is the
   original response; counts are summed before the shuffle, and only digests
   that come up more than once go on.
2. The other records of such a digest are revisits; their headers are joined to
   those of their original.
3. Archives: revisits have no payload, so their records are written from the
   headers alone. Responses are the pages that are no revisit: an anti join by
   file and row whose small side is the revisits, broadcast within the budget;
   beyond it a Bloom filter of them is probed in the scan and its few false
   positives, found among the headers, are broadcast. Payloads go from the scan
   to the writer; none is shuffled. (If even the false positives are beyond the
   budget, the pages that the filter knows are shuffled to be told apart.)
4. WARC 1.1 records with fresh headers are written by Spark's text writer (a
   record's text is its header and block, the record end is the line separator),
   each file one gzip stream, to any file system Spark reaches. Records are
   dealt to files by their size in bytes: a task's records go to groups of
   about ``file_bytes``, counted up within the task, and no file holds more than
   one group (a record that is larger by itself has a file of its own).
5. Reading back streams each archive: it is inflated piece by piece and parsed
   by its content lengths, every payload is checked against its digest, and rows
   leave in small batches, so a task holds the compressed file and one record.

Rows are told apart by the file and row they come from, so repeated rows and
ids are fine: one of them is the response. Input that does not come straight
from files is stored in the shared folder first.

Defined results: null html is the empty payload; a null page id or URL has no
header line and comes back as null (a null id is the smallest); line breaks in
URLs are percent-encoded; an empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import cut, shared_path, stored
from starloom.operators.joins import anti_join

# The base-32 alphabet of payload digests, the record end and the
# profile of revisits with an identical payload.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 64 << 20  # records in a file, uncompressed
PIECE_BYTES = 1 << 20  # how much of a file is inflated at a time
BATCH_BYTES = 8 << 20  # payloads in a batch of rows read back
OPEN_FILES = 64  # files a task writes side by side
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1 of a binary column."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), digits, BASE32)


def _identified(pages: DataFrame) -> DataFrame:
    """page_id, url, html with the file and row each comes from."""
    own = [F.col("page_id"), F.col("url"), F.coalesce("html", F.lit("")).alias("html")]
    try:
        return pages.select(*own, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        rows = pages.select(*own, F.lit("").alias("_file"), F.monotonically_increasing_id().alias("_row"))
        return stored(rows, "pages")


def resolve(pages: DataFrame, min_bytes: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(identified pages, all headers, revisits with the header of their
    original)."""
    rows = _identified(pages)
    payload = F.col("html").cast("binary")
    heads = cut(rows.select("_file", "_row", "page_id", "url", payload_digest(payload).alias("digest"), F.octet_length("html").alias("bytes")))
    first = F.max(F.struct("page_id", "_file", "_row", "url")).alias("first")
    shared = heads.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    own = (F.col("_row") == F.col("first._row")) & (F.col("_file") == F.col("first._file"))
    revisits = heads.join(cut(shared), "digest").where(~own)
    return rows, heads, cut(revisits)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    clean = F.regexp_replace(F.regexp_replace(value.cast("string"), "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _record_id(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _record(kind: str, size: Column, digest: Column, block: Column, refers: Column, date: str) -> Column:
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\n"),
        _line("WARC-Record-ID", _record_id(F.col("_file"), F.col("_row"))),
        F.lit(f"WARC-Date: {date}\r\n"),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        refers,
        _line("X-Page-ID", F.col("page_id")),
        _line("X-Payload-Bytes", size),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )


def _http(size: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"))


def responses(rows: DataFrame, heads: DataFrame, revisits: DataFrame, date: str = DATE, max_rows: int | None = None) -> DataFrame:
    """One column ``value``: the records of all pages that are no revisit."""
    pages = anti_join(rows, revisits, ["_file", "_row"], max_rows, narrow=heads)
    size = F.octet_length("html")
    block = F.concat(_http(size), F.col("html"))
    return pages.select(_record("response", size, payload_digest(F.col("html").cast("binary")), block, F.lit(""), date).alias("value"))


def revisit_records(revisits: DataFrame, date: str = DATE) -> DataFrame:
    """One column ``value``: the records of the revisits, from headers alone."""
    refers = F.concat(
        F.lit(f"WARC-Profile: {PROFILE}\r\n"), _line("WARC-Refers-To", _record_id(F.col("first._file"), F.col("first._row"))),
        _line("WARC-Refers-To-Target-URI", F.col("first.url")), _line("X-Refers-To-Page-ID", F.col("first.page_id")),
    )
    return revisits.select(_record("revisit", F.col("bytes"), F.col("digest"), _http(F.col("bytes")), refers, date).alias("value"))


def _grouped(records: DataFrame, file_bytes: int) -> DataFrame:
    """The records with the number ``g`` of the file of their task they belong
    to: a new one as soon as the bytes counted up reach ``file_bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = 0, 0
        for b in batches:
            numbers = []
            for n in pc.binary_length(b.column("value")).to_pylist():
                if held and held + n > file_bytes:
                    group, held = group + 1, 0
                held += n
                numbers.append(group)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), b.column("value")], ["g", "value"])

    return records.mapInArrow(run, "g int, value string")


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES, date: str = DATE, max_rows: int | None = None) -> None:
    """Deduplicated archives of (page_id, url, html) below ``path``. Revisits
    beyond ``max_rows`` (the session's broadcast budget, if not given) are told
    apart by a Bloom filter."""
    rows, heads, revisits = resolve(pages, min_bytes)
    records = responses(rows, heads, revisits, date, max_rows).unionByName(revisit_records(revisits, date))
    spark = pages.sparkSession
    before = spark.conf.get(_WRITERS, None)
    spark.conf.set(_WRITERS, str(OPEN_FILES))  # a task's files are open side by side: payloads are not sorted by g
    try:
        _grouped(records, file_bytes).write.option("lineSep", RECORD_END).option("compression", "gzip").partitionBy("g").text(path)
    finally:
        if before is None:
            spark.conf.unset(_WRITERS)
        else:
            spark.conf.set(_WRITERS, before)


def _inflated(content: bytes) -> Iterator[bytes]:
    """Pieces of a gzip file of one or more members."""
    at = 0
    while at < len(content):
        stream = zlib.decompressobj(31)
        while not stream.eof:
            data = stream.unconsumed_tail
            if not data:
                data = content[at : at + PIECE_BYTES]
                at += len(data)
            piece = stream.decompress(data, PIECE_BYTES)
            if not piece and not data and not stream.eof:
                raise ValueError("the archive ends in the middle of its gzip stream")
            yield piece
        at -= len(stream.unused_data)


def parse(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive that comes in pieces."""
    held, done = bytearray(), 0

    def fill(n: int) -> bool:
        """Whether n bytes are there, after reading on."""
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while fill(1):
        end, seen = -1, 0
        while (end := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not fill(seen + 1):
                raise ValueError(f"the record at byte {done} has no end of its headers")
        version, *lines = held[:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {done}")
        headers = dict(line.split(": ", 1) for line in lines)
        stop = end + 4 + int(headers["Content-Length"])
        if not fill(stop + 4) or held[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {done} does not end where it should")
        block = bytes(held[end + 4 : stop])
        del held[: stop + 4]
        done += stop + 4
        yield headers, block


def read_archives(spark: SparkSession, path: str, page_id_type: str = "long", payloads: bool = False) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, and with ``payloads`` the html of responses."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["html"] if payloads else [])]

    def rows(content: bytes) -> Iterator[tuple]:
        for headers, block in parse(_inflated(content)):
            payload = block.partition(b"\r\n\r\n")[2]
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            kind = headers["WARC-Type"]
            if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"{headers['WARC-Record-ID']}: the payload does not have its digest")
            html = [payload.decode(errors="surrogatepass") if kind == "response" else None] if payloads else []
            yield headers.get("X-Page-ID"), headers.get("WARC-Target-URI"), int(headers["X-Payload-Bytes"]), digest, kind, headers.get("X-Refers-To-Page-ID"), *html

    def batch(got: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "payload_bytes" else pa.string()) for n, c in zip(names, zip(*got, strict=True), strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                got, size = [], 0
                for row in rows(b.column("content")[i].as_py()):
                    got.append(row)
                    size += 200 + (len(row[-1] or "") if payloads else 0)
                    if size > BATCH_BYTES or len(got) == 1000:
                        yield batch(got)
                        got, size = [], 0
                if got:
                    yield batch(got)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path).select("content")
    schema = ", ".join(f"{n} {'long' if n == 'payload_bytes' else 'string'}" for n in names)
    out = files.mapInArrow(run, schema)
    return out.withColumns({c: F.col(c).cast(page_id_type) for c in ("page_id", "refers_to")})


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes archives of all pages to the shared folder and reads them back."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path, pages.schema["page_id"].dataType.simpleString())
