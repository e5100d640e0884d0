"""Web archives: pages as WARC records, read back by their lengths, and repeated payloads replaced by revisit records."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.llm.common import broadcast_if_small, measured, quoted, text_of
from navloom.session import cut_lineage, shared_dir
from navloom.sources.ingest import _remove

#: Fixed values of the format.
VERSION, END = "WARC/1.1", "\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=UTF-8{END}"
#: Bytes of records that a file holds on average; a reading task keeps a compressed file or two.
ARCHIVE_BYTES = 32 << 20
#: Bytes that a task decompresses, and payload bytes that it passes on, at once.
STEP, PASSED = 1 << 18, 8 << 20

FIELDS = "record_id string, record_type string, target string, page_id long, date string, http string, payload_digest string, payload_bytes long, refers_to string, intact boolean"


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _record(kind: Column, record_id: Column, target: Column, page_id: Column, date: Column, digest: Column, http: Column, payload: Column, refers_to: Column) -> Column:
    """One record without the line end that follows it; a revisit has the HTTP header as its whole block."""
    revisit = kind == "revisit"
    block = F.concat(http, F.lit(END), F.when(revisit, F.lit("")).otherwise(payload))
    head = F.concat(
        F.lit(VERSION + END),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.concat(F.lit("<"), record_id, F.lit(">"))),
        _line("WARC-Date", date),
        _line("WARC-Target-URI", target),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        _line("WARC-Profile", F.when(revisit, F.lit(SAME_PAYLOAD))),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<"), refers_to, F.lit(">")))),
        _line("Page-ID", page_id.cast("string")),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit(END), block, F.lit(END))


def _urn(text: Column) -> Column:
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def _saved(records: DataFrame, folder: str, per_file: int) -> None:
    """Records one after the other in gzip files: each value ends with one line end, the writer's separator is the other."""
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(folder)


def write_pages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """A response record for every page.  Null html: an empty payload.  Null id or url: no such header line.  Control characters
    of a url are written as %XX, because a header line cannot hold them."""
    payload = text_of(html_col)
    sizes = pages.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(payload) + 700).alias("bytes")).first()
    target = F.col(quoted(url_col)).cast("string")
    for code in (*range(32), 127):
        target = F.replace(target, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    number = F.monotonically_increasing_id()
    rows = pages.select(F.col(quoted(id_col)).cast("long").alias("page_id"), target.alias("target"), payload.alias("payload"), F.sha1(payload.cast("binary")).alias("digest"), number.alias("number"))
    record_id = _urn(F.concat_ws(" ", F.lit(folder), F.col("number").cast("string")))
    http = F.concat(F.lit(HTTP), _line("Content-Length", F.octet_length("payload").cast("string")))
    date = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    record = _record(F.lit("response"), record_id, F.col("target"), F.col("page_id"), date, F.col("digest"), http, F.col("payload"), F.lit(None).cast("string"))
    _saved(rows.select(record.alias("value")), folder, max(1, ARCHIVE_BYTES * sizes.n // max(1, sizes.bytes or 1)))


class _Reader:
    """Bytes of a file, plain or in any number of gzip members, decompressed in steps."""

    def __init__(self, content: bytes):
        self.content, self.at, self.held, self.used = content, 0, bytearray(), 0
        self.packed = zlib.decompressobj(31) if content[:2] == b"\x1f\x8b" else None

    def more(self) -> bool:
        del self.held[: self.used]
        self.used = 0
        step = self.content[self.at : self.at + STEP]
        self.at += len(step)
        while self.packed and step:
            self.held += self.packed.decompress(step)
            step = self.packed.unused_data
            if self.packed.eof:
                self.packed = zlib.decompressobj(31)
        self.held += step
        return self.at < len(self.content)

    def until(self, mark: bytes) -> bytes | None:
        """What stands before the next mark, which is passed; None at the end of the file."""
        seen = self.used
        while (found := self.held.find(mark, seen)) < 0:
            back = len(self.held) - self.used
            if not self.more() and self.held.find(mark, self.used) < 0:
                return None
            seen = max(0, back - len(mark))
        out = bytes(self.held[self.used : found])
        self.used = found + len(mark)
        return out

    def take(self, size: int) -> bytes:
        while len(self.held) - self.used < size and self.more():
            pass
        out = bytes(self.held[self.used : self.used + size])
        self.used += len(out)
        return out


def records_of(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header lines (names in lower case) and block of every record; ``Content-Length`` alone says where a block ends."""
    reader = _Reader(content)
    while (head := reader.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "replace").strip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:80]!r}")
        fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:] if ":" in x)}
        block = reader.take(int(fields["content-length"]))
        yield fields, block
        reader.take(4)


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """A row for every response and revisit record of all files below the folder; with ``payloads`` the payload bytes too.

    ``payload_digest`` and ``payload_bytes`` of a response are computed from the bytes that were read, and ``intact`` says whether
    they agree with its header; a revisit has what its header says, and no length.  Records of other types are passed over.
    A task holds the files it reads as they are, and one record at a time; an empty folder gives no rows.
    """
    schema = FIELDS + (", payload binary" if payloads else "")
    names = [f.split()[0] for f in schema.split(", ")]
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "intact": pa.bool_(), "payload": pa.binary()}
    bare = re.compile(r"^<?(.*?)>?$")

    def row(fields: dict[str, str], block: bytes) -> tuple:
        http, _, payload = block.partition(b"\r\n\r\n")
        said = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        revisit = fields["warc-type"] == "revisit"
        digest, size = (said, None) if revisit else (hashlib.sha1(payload).hexdigest(), len(payload))
        page = fields.get("page-id")
        refers = fields.get("warc-refers-to")
        out = (bare.match(fields["warc-record-id"])[1], fields["warc-type"], fields.get("warc-target-uri"), int(page) if page else None, fields.get("warc-date"), http.decode("utf-8", "replace") + "\r\n", digest, size, bare.match(refers)[1] if refers else None, revisit or said in (None, digest))
        return (*out, payload) if payloads else out

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, types.get(n, pa.string())) for n, c in zip(names, columns)], names)

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in records_of(content.as_py()):
                    if fields.get("warc-type") in ("response", "revisit"):
                        rows.append(row(fields, block))
                        size += 500 + len(block) * payloads
                        if size > PASSED:
                            yield passed(rows)
                            rows, size = [], 0
                yield passed(rows)

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(parse, schema)


def resolve_revisits(headers: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Headers of response records with the original each one repeats: ``record_id``, ``original`` (null: it stays a response).

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the largest page id is the original (no id
    comes last; equal ids: the largest record id).  Every task first reduces its headers to one original a digest; the
    originals come back to the headers by an equi-join that adaptive execution can split at a digest that a third of all
    records share.
    """
    own = headers.where((F.col("record_type") == "response") & (F.col("payload_bytes") >= least_bytes)).select("record_id", "payload_digest", "payload_bytes", "page_id")
    known = F.col("page_id").isNotNull()
    best = own.groupBy("payload_digest", "payload_bytes").agg(F.max(F.struct(known.alias("known"), F.col("page_id").alias("page"), F.col("record_id").alias("id"))).alias("best"), F.count(F.lit(1)).alias("n"))
    best = best.where("n > 1").select("payload_digest", "payload_bytes", F.col("best.id").alias("original"))
    return own.join(best, ["payload_digest", "payload_bytes"]).where("record_id <> original").select("record_id", "original")


def deduplicate(spark: SparkSession, source: str, target: str, least_bytes: int = 1000) -> None:
    """Writes the archives below ``source`` anew below ``target``: repeated payloads become revisit records with fresh headers.

    Headers alone are shuffled; a payload goes from the file it stands in to the new one, and only the ids of the
    records that repeat others meet the payloads (by broadcast up to a counted number of rows, by a join beyond).
    Revisit records that the source already holds are carried over with a fresh id and refer to the fresh id of their original,
    or to its original in turn.
    """
    headers = cut_lineage(read_archives(spark, source))
    sizes = headers.agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("payload_bytes", F.lit(0)) + 700).alias("bytes")).first()
    repeats = cut_lineage(resolve_revisits(headers, least_bytes))
    carried = headers.where("record_type = 'revisit' AND refers_to IS NOT NULL").select("record_id", "refers_to")
    carried = carried.join(repeats.select(F.col("record_id").alias("refers_to"), "original"), "refers_to", "left").select("record_id", F.coalesce("original", "refers_to").alias("original"))
    repeats, n = measured(repeats.union(carried))
    fresh = lambda c: _urn(F.concat_ws(" ", F.lit(target), c))
    rows = read_archives(spark, source, payloads=True).join(broadcast_if_small(repeats, n), "record_id", "left")
    kind = F.when(F.col("original").isNotNull() | (F.col("record_type") == "revisit"), F.lit("revisit")).otherwise(F.lit("response"))
    record = _record(kind, fresh(F.col("record_id")), F.col("target"), F.col("page_id"), F.col("date"), F.col("payload_digest"), F.col("http"), F.col("payload").cast("string"), fresh(F.col("original")))
    _saved(rows.select(record.alias("value")), target, max(1, ARCHIVE_BYTES * sizes.n // max(1, sizes.bytes or 1)))


def resolved(spark: SparkSession, folder: str) -> DataFrame:
    """Every record below the folder with its full payload's length: a revisit is joined to the response it refers to."""
    headers = cut_lineage(read_archives(spark, folder))
    originals = headers.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("original_page"), F.col("payload_digest").alias("original_digest"), F.col("payload_bytes").alias("original_bytes"))
    wanted = ["record_id", "record_type", "target", "page_id", "date", "intact"]
    responses = headers.where("record_type = 'response'").select(*wanted, "payload_digest", "payload_bytes", F.lit(None).cast("long").alias("original_page"))
    revisits = headers.where("record_type = 'revisit'").join(originals, "refers_to", "left")
    same = F.col("intact") & F.col("payload_digest").eqNullSafe(F.col("original_digest"))
    return responses.union(revisits.select(*wanted[:-1], same.alias("intact"), "payload_digest", F.col("original_bytes").alias("payload_bytes"), "original_page"))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder of the shared one; it goes when the block ends."""
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        _remove(spark, folder)


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 1000) -> DataFrame:
    """Pages to archives, archives without repeated payloads, and what reading those gives: the rows of :func:`resolved`.

    One row per page.  Null html: an empty payload.  Repeated rows: one is the response, the others revisit it.  Null ids are
    kept and rank last.  Empty table: no rows.  Other columns are not read.
    """
    spark = pages.sparkSession
    with scratch(spark) as folder:
        write_pages(pages, f"{folder}/crawl", id_col, url_col, html_col)
        deduplicate(spark, f"{folder}/crawl", f"{folder}/deduplicated", least_bytes)
        return cut_lineage(resolved(spark, f"{folder}/deduplicated"))
