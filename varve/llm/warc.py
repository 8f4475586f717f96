"""WARC archives: segmented, chunked records written and read with Spark's own file sources.

A page becomes an HTTP response in chunked framing. A block longer than ``segment_bytes`` is split into a first record
and continuation records, which name the first by ``WARC-Segment-Origin-ID``. Reading finds records by their lengths,
groups segments by origin, orders them by number, checks the total length, and undoes the framing.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import reachable

SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
RECORDS_PER_FILE = 2_048
END = b"\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"  # of all records, so that archives of equal pages are equal
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id string, type string, origin_id string, segment long, total_length long, refers_to string, digest string, url string, block binary, start long, whole boolean"
_ARROW = pa.schema(
    [
        *((n, pa.string()) for n in ("record_id", "type", "origin_id")),
        ("segment", pa.int64()),
        ("total_length", pa.int64()),
        *((n, pa.string()) for n in ("refers_to", "digest", "url")),
        ("block", pa.binary()),
        ("start", pa.int64()),
        ("whole", pa.bool_()),
    ]
)


def digest32(payload: bytes) -> str:
    """SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A payload in chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of chunked framing, or None where the framing is broken; chunk extensions are passed over."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            return None
        head = body[at:line].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]+", head):
            return None
        size, at = int(head, 16), line + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes | None:
    """The payload of an HTTP message, or None where it is broken."""
    head, gap, body = block.partition(END)
    if not gap:
        return None
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", head) else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def _line(text: str | None) -> str | None:
    """A header value cannot hold line ends or other controls; they are percent-encoded."""
    return None if text is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _made(segment_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            held = 0
            for name, url, payload, digest, refers in zip(*(c for c in batch.columns), strict=True):
                name, url, digest, refers = name.as_py(), _line(url.as_py()), digest.as_py(), refers.as_py()
                body = payload.as_py() or b""
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                common = [("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}")]
                kind = ("Content-Type", "application/http; msgtype=response")
                if refers is not None:
                    more = [("WARC-Refers-To", f"<{refers}>"), ("WARC-Profile", REVISIT_PROFILE), kind]
                    made = [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), *common, *more], HTTP_HEAD)]
                else:
                    block = HTTP_HEAD + chunked(body)
                    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
                    first = [("WARC-Segment-Number", 1)] if len(parts) > 1 else []
                    made = [_record([("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), *common, *first, kind], parts[0])]
                    for i, part in enumerate(parts[1:], 2):
                        total = len(block) if i == len(parts) else None
                        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{i}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", f"<{name}>")]
                        made.append(_record([*own, ("WARC-Segment-Number", i), ("WARC-Segment-Total-Length", total)], part))
                out += made
                held += sum(map(len, made))
                if held > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    return run


def write_archive(records: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write ``records(record_id, url, payload, sha1, refers_to)`` as WARC files, compressed file by file.

    ``sha1`` is the payload's, in hexadecimal. Where ``refers_to`` names another record, a revisit without payload is
    written. Files hold at most ``RECORDS_PER_FILE`` records, so that none grows with the input.
    """
    reachable(records.sparkSession)
    rows = records.select("record_id", "url", "payload", "sha1", "refers_to").mapInArrow(_made(segment_bytes), "value binary")
    text = rows.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


_LINE = b"\nWARC/"
_PLAIN = ("record_id", "type", "origin_id", "segment", "total_length", "refers_to", "digest", "url")


def _number(text: str | None) -> int | None:
    """A number of a header, or None where there is none or it is no count of bytes or segments."""
    return int(text) if text is not None and re.fullmatch(r"[0-9]{1,18}", text) else None


def _bare(text: str | None) -> str | None:
    return None if text is None else text.strip("<>")


def parsed(data: bytes) -> Iterator[dict]:
    """The records of an archive file, found by their lengths, and what is damaged.

    ``start`` is the byte at which a record begins. Bytes that are no record come as rows with nothing but ``block`` and
    ``start``, ``whole`` false, and reading goes on at the next line that begins ``WARC/``. So does a record whose
    Content-Length is missing, unreadable, beyond the end of the file, or not followed by the end of a record: its row
    has its fields, what there is of its block, and ``whole`` false. An empty file has no rows.
    """
    at, end = 0, len(data)

    def next_record(after: int) -> int:
        return data.find(_LINE, after - 1) + 1 or end

    while at < end:
        if data[at : at + 1] in (b"\r", b"\n"):
            at += 1
            continue
        stop = next_record(at + 1)
        head = data.find(END, at, stop)
        if not data.startswith(b"WARC/", at) or head < 0:
            yield {**dict.fromkeys(_PLAIN), "block": data[at:stop], "start": at, "whole": False}
            at = stop
            continue
        lines = (line.partition(":") for line in data[at:head].decode("utf-8", "replace").split("\r\n"))
        fields = {k.lower(): v.strip(" \t") for k, colon, v in lines if colon}
        length, first = _number(fields.get("content-length")), head + len(END)
        last = end + 1 if length is None else first + length
        rest = data[last : last + len(END)]
        whole = last <= end and (rest == END[: len(rest)] or data.startswith(b"WARC/", last))
        if not whole:
            last = next_record(first)
        block = data[first:last] if whole else data[first:last].removesuffix(END)
        digest = fields.get("warc-payload-digest")
        yield {
            "record_id": _bare(fields.get("warc-record-id", "")),
            "type": fields.get("warc-type"),
            "origin_id": _bare(fields.get("warc-segment-origin-id")),
            "segment": _number(fields.get("warc-segment-number")),
            "total_length": _number(fields.get("warc-segment-total-length")),
            "refers_to": _bare(fields.get("warc-refers-to")),
            "digest": None if digest is None else digest.removeprefix("sha1:"),
            "url": fields.get("warc-target-uri"),
            "block": block,
            "start": at,
            "whole": whole,
        }
        at = last


_GZIP = b"\x1f\x8b\x08"
_PIECE = 1 << 16


def inflated(data: bytes) -> tuple[bytes, bool]:
    """The content of a gzip file of one or more members, and whether all of it could be read.

    Of a damaged member what comes before the damage is kept, and reading goes on at the next member.
    """
    out, at, sound = [], 0, True
    while at < len(data):
        member, start = zlib.decompressobj(wbits=31), at
        try:
            while at < len(data) and not member.eof:
                out.append(member.decompress(data[at : at + _PIECE]))
                at = min(at + _PIECE, len(data)) - len(member.unused_data)
            sound &= member.eof
        except zlib.error:
            found, sound = data.find(_GZIP, start + 1), False
            at = found if found >= 0 else len(data)
            out.append(b"\n")  # so that the next member begins a line
    return b"".join(out), sound


def read_records(spark: SparkSession, path: str, part: str = "all") -> DataFrame:
    """The records of all archive files below ``path``; ``part`` may ask for ``whole``, ``segments``, ``revisits`` or ``damaged``.

    Damaged files end no job: what is no record comes as a row without type, see :func:`parsed`, also for a gzip file
    that is cut or broken, whose lost rest is an empty row. ``damaged`` are these, and records that are not whole.
    """
    reachable(spark)

    def wanted(r: dict) -> bool:
        if part == "damaged":
            return not r["whole"]
        kind = "none" if r["type"] is None else "revisits" if r["type"] == "revisit" else "segments" if r["segment"] is not None else "whole"
        return part in ("all", kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                lost: list[dict] = []
                if data[:2] == b"\x1f\x8b":
                    data, sound = inflated(data)
                    lost = [] if sound else [{**dict.fromkeys(_PLAIN), "block": b"", "start": len(data), "whole": False}]
                rows, held = [], 0
                for r in filter(wanted, itertools.chain(parsed(data), lost)):
                    rows.append(r)
                    held += len(r["block"])
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def reassembled(segments: DataFrame) -> DataFrame:
    """One row per origin: ``(record_id, digest, url, blocks, complete)``.

    Segments are grouped by origin id and ordered by number; repeats of one segment count once. ``complete`` says that
    the numbers run from 1 without a gap and that the lengths sum to the total that the last one states. Segments that
    are not whole are left out, so that a whole repeat of one takes its place.
    """
    keyed = segments.where("whole").select(F.coalesce("origin_id", "record_id").alias("record_id"), "segment", "total_length", "digest", "url", "block")
    parts = F.sort_array(F.collect_set(F.struct("segment", "block")))
    out = keyed.groupBy("record_id").agg(F.max("digest").alias("digest"), F.max("url").alias("url"), F.max("total_length").alias("total"), parts.alias("parts"))
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + F.length(p["block"]))
    ordered = F.transform("parts", lambda p: p["segment"]) == F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long"))
    return out.select("record_id", "digest", "url", F.transform("parts", lambda p: p["block"]).alias("blocks"), F.coalesce(ordered & (length == F.col("total")), F.lit(False)).alias("complete"))


def responses(spark: SparkSession, path: str) -> DataFrame:
    """Every response with its payload: ``(record_id, url, digest, payload, valid)``.

    ``valid`` says that all segments are there, the framing is whole and the payload has the digest stated; the payload
    of a record with missing segments, a short block or broken framing is null. Archives without records give no rows.
    """
    whole = read_records(spark, path, "whole").where("type = 'response'").select("record_id", "digest", "url", F.array("block").alias("blocks"), F.col("whole").alias("complete"))
    both = whole.union(reassembled(read_records(spark, path, "segments")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [http_payload(b"".join(b.as_py())) if c.as_py() else None for b, c in zip(batch.column(3), batch.column(4), strict=True)]
            valid = [p is not None and (d is None or digest32(p) == d) for p, d in zip(payloads, batch.column(1).to_pylist(), strict=True)]
            arrays = [batch.column(0), batch.column(2), batch.column(1), pa.array(payloads, pa.binary()), pa.array(valid)]
            yield pa.RecordBatch.from_arrays(arrays, names=["record_id", "url", "digest", "payload", "valid"])

    return both.select("record_id", "digest", "url", "blocks", "complete").mapInArrow(run, "record_id string, url string, digest string, payload binary, valid boolean")


def revisits(spark: SparkSession, path: str) -> DataFrame:
    """Every revisit: ``(record_id, url, digest, refers_to)``."""
    return read_records(spark, path, "revisits").select("record_id", "url", "digest", "refers_to")


COPIES_A_BLOCK = 1_000


def page_records(pages: DataFrame, least_bytes: int = 0, cut=lambda df, name: df) -> DataFrame:
    """Records of ``pages(page_id, url, html)`` for ``write_archive``, one per row.

    Of pages with equal payloads of at least ``least_bytes``, the one with the smallest id is the response and the
    others revisit it; repeated rows of the smallest id are all responses, and so are pages that have no id but null.
    A record's id is made of page id and payload digest. Where several rows agree in both, all but one add a digest of
    their url and a number, so that each has an id of its own. Null urls and html are rows like any others; an empty
    table gives no records; other columns are passed over.

    Only ids and digests are shuffled; pages meet their responses by page id, which no hot payload can skew. Rows that
    repeat in full are counted, kept once, and written as often as they occur by blocks of ``COPIES_A_BLOCK``.
    """
    keys = ["page_id", "sha1", "place"]
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    plain = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"), F.sha1(F.col("url").cast("binary")).alias("place"))
    smallest = F.min(F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "place")).alias("least")
    shared = plain.groupBy("sha1").agg(smallest, F.count("*").alias("rows"), F.max(F.length("payload")).alias("size")).where("rows > 1")
    shared = cut(shared.select("sha1", F.col("least.page_id").alias("first"), F.col("least.place").alias("at"), (F.col("size") >= least_bytes).alias("linked")), "first")
    leads = F.col("page_id").eqNullSafe(F.col("first")) & F.col("place").eqNullSafe(F.col("at"))
    again = plain.select(*keys).join(shared, "sha1").groupBy(*keys, "first", "linked", leads.alias("leads")).agg(F.count("*").alias("n"))
    again = cut(again.where("n > 1 or not leads"), "again").withColumnsRenamed({k: f"r_{k}" for k in keys})
    same = F.col("page_id").eqNullSafe(F.col("r_page_id")) & (F.col("sha1") == F.col("r_sha1")) & F.col("place").eqNullSafe(F.col("r_place"))
    joined = plain.join(again, same, "left").drop("r_page_id", "r_sha1", "r_place")
    once = joined.where("n is null or n = 1").withColumn("copy", F.lit(1).cast("long"))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES_A_BLOCK}")))
    low = F.col("block") * COPIES_A_BLOCK + 1
    copies = F.explode(F.sequence(low, F.least(F.col("n"), low + (COPIES_A_BLOCK - 1))))
    many = joined.where("n > 1").dropDuplicates(keys).withColumn("block", blocks)
    many = many.repartition(*keys, "block").withColumn("copy", copies).drop("block")

    def name(page: str) -> Column:
        return F.concat_ws(":", F.lit("urn:page"), F.coalesce(F.col(page).cast("string"), F.lit("")), "sha1")

    own = F.when(F.col("n").isNull() | (F.col("leads") & (F.col("copy") == 1)), name("page_id"))
    own = own.otherwise(F.concat_ws(":", name("page_id"), F.coalesce("place", F.lit("")), F.col("copy").cast("string")))
    other = F.when(F.col("linked") & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), name("first"))
    return once.unionByName(many).select(own.alias("record_id"), "url", "payload", "sha1", other.alias("refers_to"))


def page_of(record: str) -> Column:
    """The page id in a record id that ``page_records`` made."""
    return F.nullif(F.split_part(F.col(record), F.lit(":"), F.lit(3)), F.lit("")).cast("long")
