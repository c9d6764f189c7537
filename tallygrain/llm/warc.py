"""WARC archives: writing segmented, chunk-framed records and putting them together again."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.llm.common import ASCII_LOWER, require, ship_by_value, table
from tallygrain.session import materialize, scratch_path

ship_by_value(__name__)

#: Records with longer blocks are cut into segments of this many bytes; chunks of the transfer framing; records an archive file.
SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
RECORDS_PER_FILE = 4096

_VERSION = b"WARC/1.1"
_END = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_REVISIT_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:tallygrain:page:"


def base32_digest(sha1_hex: Column) -> Column:
    """Upper-case base32 of a hexadecimal SHA-1: each ten hexadecimal digits are eight digits to the base 32."""
    parts = [F.lpad(F.conv(F.substring(sha1_hex, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.lower(F.concat(*parts)), "0123456789" + ASCII_LOWER[:22], "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def frame_chunks(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    out = []
    for i in range(0, len(payload), size):
        part = payload[i : i + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def unframe_chunks(body: bytes) -> bytes:
    """Payload of a chunk-framed body; extensions and trailers are skipped. Raises ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("no chunk size")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("short chunk")
        out.append(body[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))])
    return _VERSION + b"\r\n" + head.encode() + b"\r\n" + block


def _one_line(text: str | None) -> str:
    return "".join(c for c in text or "" if c >= " ")


def _write_rows(segment: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, url, html, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                common = [("WARC-Target-URI", _one_line(url)), ("WARC-Date", "2024-01-01T00:00:00Z")]
                first = [("WARC-Payload-Digest", "sha1:" + digest), ("Content-Type", "application/http; msgtype=response")]
                if refers is not None:
                    own = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Refers-To", f"<{refers}>"), ("WARC-Profile", _PROFILE)]
                    out.append(_record([*own, *common, *first], _REVISIT_HTTP))
                    continue
                block = _HTTP + frame_chunks((html or "").encode("utf-8", "surrogatepass"), chunk)
                own = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), *common, *first]
                if len(block) <= segment:
                    out.append(_record(own, block))
                    continue
                for number, at in enumerate(range(0, len(block), segment), 1):
                    part, last = block[at : at + segment], at + segment >= len(block)
                    if number == 1:
                        headers = [*own, ("WARC-Segment-Number", 1)]
                    else:
                        headers = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{number}>"), *common, ("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Segment-Number", number)]
                    out.append(_record(headers + [("WARC-Segment-Total-Length", len(block))] * last, part))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return run


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES, min_revisit_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write a record per row of ``pages`` (``page_id``, ``url``, ``html``) into gzip archives below ``path``.

    Of rows with equal payloads of ``min_revisit_bytes`` or more, those with the largest ``page_id`` are responses, the others revisit one
    of them. NULL html is an empty payload. Spark's writer commits the files, so that a lost executor leaves no half archive.
    """
    require(pages, "page_id", "url", "html")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", base32_digest(F.sha1(payload)).alias("digest"), F.octet_length(payload).alias("bytes"), F.monotonically_increasing_id().alias("row"))
    name = F.concat(F.lit(_URN), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(":"), F.col("row").cast("string"))
    heads = rows.where(F.col("bytes") >= min_revisit_bytes).groupBy("digest").agg(F.max(F.struct("page_id", "row")).alias("m"), F.count("*").alias("n")).where("n > 1")
    groups = materialize(heads.select(F.col("digest").alias("d"), F.col("m.page_id").alias("top"), F.concat(F.lit(_URN), F.col("m.page_id").cast("string"), F.lit(":"), F.col("m.row").cast("string")).alias("refers")), "groups")
    joined = rows.join(groups, (F.col("digest") == F.col("d")) & (F.col("bytes") >= min_revisit_bytes), "left")
    revisit = F.when(F.col("top").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("top"))), F.col("refers"))
    records = joined.select(name.alias("name"), "url", F.when(revisit.isNull(), F.col("html")).alias("html"), "digest", revisit.alias("refers"))
    text = records.mapInArrow(_write_rows(segment_bytes, chunk_bytes), "record binary").select(F.col("record").cast("string"))
    # A record ends with two line ends: the writer's separator.
    text.write.option("lineSep", _END.decode()).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts here: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) and (line := line.rstrip(b"\r\n")):
            key, _, value = line.decode("utf-8", "replace").partition(":")
            headers[key.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers["content-length"]))


_PARSED = [
    ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("url", pa.string()), ("digest", pa.string()),
    ("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()), ("block", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("problem", pa.string()), ("payload", pa.binary()),
]
_PARSED_SQL = "record_id string, record_type string, refers_to string, url string, digest string, origin string, number long, total long, block binary, payload_bytes long, payload_digest string, problem string, payload binary"


def _bare(value: str | None) -> str | None:
    return None if value is None else value.strip("<>")


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _opened(block: bytes, digest: str | None) -> tuple[int | None, str | None, str | None, bytes | None]:
    """Length, digest, problem and payload of an HTTP response block."""
    head, end, body = block.partition(b"\r\n\r\n")
    try:
        fields = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n"))}
        payload = unframe_chunks(body) if fields.get(b"transfer-encoding") == b"chunked" else body
    except ValueError as error:
        return None, None, str(error), None
    own = _digest(payload)
    return len(payload), own, "digest differs" if digest and digest != own else None, payload


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_PARSED)], [n for n, _ in _PARSED])


def _parse_files(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                raw = io.BytesIO(content.as_py())
                with gzip.open(raw) if raw.getvalue()[:2] == b"\x1f\x8b" else raw as stream:
                    for h, block in parse_records(stream):
                        kind, number = h.get("warc-type"), h.get("warc-segment-number")
                        digest = (h.get("warc-payload-digest") or "").removeprefix("sha1:") or None
                        origin = _bare(h.get("warc-segment-origin-id") or (h.get("warc-record-id") if number else None))
                        row = [_bare(h.get("warc-record-id")), kind, _bare(h.get("warc-refers-to")), h.get("warc-target-uri"), digest, origin]
                        if origin:
                            row += [int(number or 0), int(x) if (x := h.get("warc-segment-total-length")) else None, block, None, None, None, None]
                        elif kind == "response":
                            n, own, problem, payload = _opened(block, digest)
                            row += [None, None, None, n, own, problem, payload if with_payload else None]
                        else:
                            row += [None, None, None, None, None, None, None]
                        rows.append(tuple(row))
                        held += len(block)
                        if held > 8_000_000:
                            yield _batch(rows)
                            rows, held = [], 0
                yield _batch(rows)

    return run


def _join_segments(with_payload: bool):
    """Rows sorted by origin and number become one row an origin."""

    def closed(rows: list[dict]) -> tuple:
        first, last = rows[0], rows[-1]
        problem, parts = None, []
        for expected, r in enumerate(rows, 1):
            if r["number"] != expected:
                problem = f"segment {expected} is missing"
                break
            parts.append(r["block"])
        block = b"".join(parts)
        if problem is None and last["total"] != len(block):
            problem = "total length differs" if last["total"] is not None else "the last segment is missing"
        n = own = payload = None
        if problem is None:
            n, own, problem, payload = _opened(block, first["digest"])
        return (first["origin"], first["record_type"], None, first["url"], first["digest"], None, None, None, None, n, own, problem, payload if with_payload else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                r = {n: batch.column(n)[i].as_py() for n in ("origin", "number", "total", "block", "record_type", "url", "digest")}
                if rows and rows[0]["origin"] != r["origin"]:
                    out.append(closed(rows))
                    rows = []
                if not rows or rows[-1]["number"] != r["number"]:  # a segment that was archived twice counts once
                    rows.append(r)
            yield _batch(out)
        if rows:
            yield _batch([closed(rows)])

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per response and revisit record: ``record_id``, ``record_type``, ``refers_to``, ``url``, ``payload_bytes``, ``payload_digest``, ``problem`` and ``payload``.

    Segments are shuffled by the record they continue and sorted by their number, so that a task holds one payload at a time; records in one
    piece are decoded where they are read. Missing segments, a wrong total length, broken chunks and a wrong digest are told in
    ``problem``. A revisit has the length, digest and payload of the record it refers to, NULL if that is not there. A folder
    without archives gives no row.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    parsed = materialize(files.mapInArrow(_parse_files(with_payload), _PARSED_SQL), "records")
    segments = parsed.where("origin is not null").repartition("origin").sortWithinPartitions("origin", "number")
    whole = parsed.where("origin is null and record_type = 'response'").unionByName(segments.mapInArrow(_join_segments(with_payload), _PARSED_SQL)).drop("origin", "number", "total", "block")
    target = whole.select(F.col("record_id").alias("t"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("g"), F.col("payload").alias("p"))
    again = parsed.where("record_type = 'revisit'").drop("origin", "number", "total", "block", "payload_bytes", "payload_digest", "payload")
    found = again.join(target, F.col("refers_to") == F.col("t"), "left")
    problem = F.when(F.col("t").isNull(), "the record it refers to is missing").when(F.col("g") != F.col("digest"), "digest differs")
    revisits = found.withColumns({"payload_bytes": F.col("b"), "payload_digest": F.col("g"), "payload": F.col("p"), "problem": problem})
    names = ["record_id", "record_type", "refers_to", "url", "payload_bytes", "payload_digest", "problem", "payload"]
    return whole.select(*names).unionByName(revisits.select(*names))


def page_of(record_id: Column) -> Column:
    """The page id in a record id of ``write_archives``; NULL if it has none."""
    return F.nullif(F.regexp_extract(record_id, f"{_URN}(-?[0-9]*):", 1), F.lit("")).cast("long")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    back = read_archives(spark, path, with_payload=False)
    return back.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to")).alias("refers_to"))


OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS h FROM p),
b AS (
  SELECT page_id, n, h, max(page_id) OVER (PARTITION BY h) AS top,
    array_to_string(list_transform(string_split(h, ''), lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), '') AS bits FROM d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(list_transform(range(5), lambda j: CAST(substr(bits, CAST(5 * i + j + 1 AS INT), 1) AS INT) * pow(2, 4 - j))) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id < top OR page_id IS NULL AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < top OR page_id IS NULL THEN top END AS refers_to
FROM b
"""
