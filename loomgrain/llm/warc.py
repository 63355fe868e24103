"""WARC archives: write pages as records, read archives, assemble transactions.

``write_archive`` writes three records for each page, a request, a response or revisit, and a metadata record, as
WARC/1.1 files through Spark's own text writer (a record ends with two line ends, which is the writer's row
separator), so any store that Spark writes to will do; that writer makes one gzip member a file. Records equal in payload, if it
is long enough, keep one response; the others are revisits that refer to it. ``read_archive`` parses archives (plain or gzip, one
or many members) by their content lengths, inflating a piece at a time. ``assemble`` joins request, response and metadata
records through their concurrent-to identifiers, of which a record may have several, in either direction and over any
number of intermediate records, into one nested row per capture.

A file's bytes are read by one task, so archives should stay well under 1 GB; the writer closes files at about
``file_bytes``. Digests are summed up by a partial aggregate and met again by an equi-join. Record identifiers number
the rows of ``pages``, which should therefore be a stored table and not a plan that may number its rows anew.

Defined results: null payloads count as empty; a null key gives a null page; a null URL gives no target URI; blanks and control
characters in URLs are written as %20 in headers; rows with the same key and payload are all responses if theirs is the
largest key; a side record that reaches several captures goes to the one of smallest identifier; side records without a
capture give a capture row with null record fields, under the smallest identifier that they name; bytes that are no record
are skipped, a record cut off by the end of its file is left out, and where gzip data is damaged reading goes on at
the next member; an empty table gives an empty archive and no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.session import Scratch

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRIMARY = ("response", "revisit", "resource", "conversion")
_RECORD = (
    "record_id string, record_type string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
    "digest string, headers map<string,string>, http_head string, payload_length long, payload_sha1 string, payload binary"
)


def _record(kind: str, rid: Column, block: Column, content_type: str, *fields: tuple[str, Column]) -> Column:
    """One record's text without its closing line ends; fields with null values are left out."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), rid)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    lines += [F.lit(f"Content-Type: {content_type}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def write_archive(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit_bytes: int = 1000,
    date: str = "2024-01-01T00:00:00Z",
    file_bytes: int = 16 << 20,
    compression: str = "gzip",
) -> None:
    """Write pages as an archive folder; among equal payloads the row with the largest key is the response."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).alias("k"), F.col(url).cast("string").alias("u"), body.alias("b")).withColumns(
        {"n": F.octet_length("b").cast("long"), "digest": F.sha1("b"), "seq": F.monotonically_increasing_id()}
    )
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("bytes")).first()
    mean = 1500 + (total.bytes or 0) // max(1, total.n)
    long = rows.where(F.col("n") >= min_revisit_bytes)
    kept = (
        long.groupBy("digest", "n")
        .agg(F.max(F.struct("k", "seq")).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("digest", "n", "first")
    )
    met = rows.join(kept, ["digest", "n"], "left")

    def rid(kind: str, k: Column, seq: Column) -> Column:
        h = F.md5(F.concat_ws(":", F.lit(kind), F.coalesce(k.cast("string"), F.lit("null")), seq.cast("string")))
        parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    again = F.col("first").isNotNull() & ~F.col("first.k").eqNullSafe(F.col("k"))
    k, seq, n = F.col("k"), F.col("seq"), F.col("n").cast("string")
    main = rid("response", k, seq)
    common = (
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.regexp_replace("u", r"[\x00-\x20\x7F]", "%20")),
    )
    after = F.when(F.instr("u", "://") > 0, F.substr("u", F.instr("u", "://") + 3))
    host = F.regexp_replace(F.coalesce(F.regexp_extract(after, "^[^/?#]*", 0), F.lit("")), r"[\x00-\x20\x7F]", "%20")
    target = F.regexp_replace(F.coalesce(F.regexp_extract(after, "^[^/?#]*([^#]*)", 1), F.lit("")), r"[\x00-\x20\x7F]", "%20")
    request = F.concat(
        F.lit("GET "), F.when(target.startswith("/"), target).otherwise(F.concat(F.lit("/"), target)),
        F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF + CRLF),
    )
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), n, F.lit(CRLF + CRLF)
    )
    notes = F.concat(F.lit("pageId: "), F.coalesce(k.cast("string"), F.lit("")), F.lit(CRLF))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    joined = ("WARC-Concurrent-To", main)
    response = _record("response", main, F.concat(head, F.col("b")), "application/http; msgtype=response", *common, digest)
    revisit = _record(
        "revisit", main, head, "application/http; msgtype=response", *common, digest, ("WARC-Profile", F.lit(PROFILE)),
        ("WARC-Refers-To", rid("response", F.col("first.k"), F.col("first.seq"))),
    )
    records = F.array(
        _record("request", rid("request", k, seq), request, "application/http; msgtype=request", *common, joined),
        F.when(again, revisit).otherwise(response),
        _record("metadata", rid("metadata", k, seq), notes, "application/warc-fields", *common, joined),
    )
    each = max(3, 3 * (file_bytes // mean))
    out = met.select(F.explode(records).alias("value"))
    out.write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", each).option("compression", compression).text(path)


_GZIP = b"\x1f\x8b"
_MEMBER = b"\x1f\x8b\x08"
_PIECE = 1 << 14


def _pieces(data: bytes) -> Iterator[bytes | None]:
    """Plain bytes of a file, which may be gzip with any number of members, in pieces; None where some are lost."""
    if data[:2] != _GZIP:
        yield data
        return
    view, at = memoryview(data), 0
    while 0 <= at < len(data):
        if data[at : at + 2] != _GZIP:
            at = data.find(_MEMBER, at)
            continue
        member, begin = zlib.decompressobj(31), at
        try:
            while at < len(data) and not member.eof:
                part = view[at : at + _PIECE]
                yield member.decompress(part)
                at += len(part)
            at -= len(member.unused_data)
        except zlib.error:
            yield None
            at = data.find(_MEMBER, begin + 1)


_START = re.compile(rb"WARC/1\.[01]\r\n")
_END = b"\r\n\r\n"


def _fields(head: bytes) -> list[tuple[str, str]]:
    """Header fields with lower-case names in order; folded lines are joined."""
    text = re.sub(r"\r\n[ \t]+", " ", head.decode("utf-8", "replace"))
    lines = (line.partition(":") for line in text.split(CRLF))
    return [(name.strip().lower(), value.strip()) for name, colon, value in lines if colon]


def _told(fields: list[tuple[str, str]], headers: dict[str, str], block: bytes) -> tuple:
    http, payload = None, block
    if headers.get("content-type", "").startswith("application/http"):
        cut = block.find(_END)
        http, payload = (block, b"") if cut < 0 else (block[:cut], block[cut + 4 :])
    named = ("warc-refers-to", "warc-target-uri", "warc-date", "warc-payload-digest")
    return (
        headers.get("warc-record-id"),
        headers.get("warc-type"),
        [v for k, v in fields if k == "warc-concurrent-to"] or None,
        *map(headers.get, named),
        headers,
        None if http is None else http.decode("utf-8", "replace"),
        len(payload),
        hashlib.sha1(payload).hexdigest(),
        payload,
    )


def parse_records(pieces: Iterable[bytes | None]) -> Iterator[tuple]:
    """Tuples in the order of the record schema from consecutive pieces of a file; of a repeated header the map has the first.

    What is held is the record at hand and one piece. None drops what is held, for its end is lost.
    """
    held, need = bytearray(), 1
    for piece in pieces:
        if piece is None:
            held, need = bytearray(), 1
            continue
        held += piece
        if len(held) < need:
            continue
        at = 0
        while True:
            m = _START.search(held, at)
            if not m:
                # a start may be cut in two
                at, need = max(at, len(held) - 10), 1
                break
            stop = held.find(_END, m.end() - 2)
            if stop < 0:
                at, need = m.start(), 1
                break
            fields = _fields(bytes(held[m.end() : stop]))
            headers = dict(reversed(fields))
            size = headers.get("content-length", "")
            if not size.isdigit():
                at = m.end()
                continue
            end = stop + 4 + int(size)
            if end > len(held):
                at, need = m.start(), end - m.start()
                break
            yield _told(fields, headers, bytes(held[stop + 4 : end]))
            at = end
        del held[:at]


_ARROW = [
    *[pa.string()] * 2,
    pa.list_(pa.string()),
    *[pa.string()] * 4,
    pa.map_(pa.string(), pa.string()),
    pa.string(),
    pa.int64(),
    pa.string(),
    pa.binary(),
]


def read_archive(
    spark: SparkSession, path: str, payload_of: tuple[str, ...] | None = None, batch_bytes: int = 8 << 20
) -> DataFrame:
    """One row per record of every file under path; with payload_of, only records of those types bring their payload."""
    names = [x.strip().split(" ")[0] for x in re.sub("map<string,string>", "map", _RECORD).split(",")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            columns[7] = [list(h.items()) for h in columns[7]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW, strict=True)], names=names)

        for b in batches:
            for raw in b.column(0):
                rows, held = [], 0
                for r in parse_records(_pieces(raw.as_py())):
                    if payload_of is not None and r[1] not in payload_of:
                        r = (*r[:-1], None)
                    rows.append(r)
                    held += len(r[-1] or b"") + 500
                    if held > batch_bytes:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(parse, _RECORD)


def _anchors(primary: DataFrame, side: DataFrame) -> DataFrame:
    """(__sid, __anchor): the capture that each side record with links reaches, else the smallest identifier it names.

    Links hold in both directions. Each round settles the records one link further from a capture; most archives need one.
    """
    scratch = Scratch(side.sparkSession, "links")
    captures = primary.select(F.col("record_id").alias("__to")).where("__to is not null").distinct()
    told = side.select(F.col("record_id").alias("__sid"), F.explode("concurrent_to").alias("__to"))
    back = primary.select(F.explode("concurrent_to").alias("__sid"), F.col("record_id").alias("__to"))
    own = side.select(F.col("record_id").alias("__sid")).where("__sid is not null").distinct()
    links = scratch.save(told.unionByName(back.join(own, "__sid", "left_semi")).distinct(), "links")
    least = F.min("__to").alias("__anchor")
    settled = scratch.save(links.join(captures, "__to", "left_semi").groupBy("__sid").agg(least), "settled")
    between = links.join(own.withColumnRenamed("__sid", "__to"), "__to", "left_semi").select("__sid", "__to")
    between = scratch.save(between.unionByName(between.select(F.col("__to").alias("__sid"), F.col("__sid").alias("__to"))), "between")
    new = settled
    while between.limit(1).count() and new.limit(1).count():
        reached = between.join(new.select(F.col("__sid").alias("__to"), "__anchor"), "__to").join(settled, "__sid", "left_anti")
        new = scratch.save(reached.groupBy("__sid").agg(F.min("__anchor").alias("__anchor")), "settled")
        settled = settled.unionByName(new)
    rest = links.join(settled, "__sid", "left_anti")
    return settled.unionByName(rest.groupBy("__sid").agg(least))


def assemble(records: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per capture: the primary record's columns with arrays ``requests`` and ``metadata`` of its side records.

    columns: what to keep of each record (all by default); record_id, record_type and concurrent_to always stay.
    """
    always = ["record_id", "record_type", "concurrent_to"]
    wanted = [c for c in (columns or records.columns) if c not in always]
    records = records.select(*always, *wanted)
    primary = records.where(F.col("record_type").isin(*PRIMARY))
    side = records.where(F.col("record_type").isin("request", "metadata"))
    resolved = _anchors(primary, side)
    placed = side.join(resolved, side["record_id"] == resolved["__sid"], "left").withColumn(
        "__anchor", F.coalesce("__anchor", "record_id")
    )
    nested = F.struct("record_id", *wanted)
    grouped = placed.groupBy("__anchor").agg(
        *[
            F.collect_list(F.when(F.col("record_type") == t, nested)).alias(name)
            for t, name in (("request", "requests"), ("metadata", "metadata"))
        ]
    )
    empty = {n: grouped.schema[n].dataType.simpleString() for n in ("requests", "metadata")}
    joined = primary.join(grouped, primary["record_id"] == grouped["__anchor"], "full_outer")
    return joined.select(
        F.coalesce("record_id", "__anchor").alias("capture_id"),
        *[F.col(c) for c in [*always, *wanted]],
        *[F.coalesce(n, F.array().cast(t)).alias(n) for n, t in empty.items()],
    )
