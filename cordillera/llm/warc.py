"""WARC archives: writing with deduplication, and reading with segment reassembly.

Writing frames each page as an HTTP response in chunked transfer coding.  A page
whose payload equals that of a page with a smaller id becomes a revisit record; a
block that is longer than a segment goes out as one record and continuation
records.  Spark's text writer puts the blank lines after each record, so the parts
of an archive are committed or dropped as a whole when executors are lost.

Reading parses each archive by Content-Length.  Continuation records are grouped by
their origin's identifier and ordered by segment number; gaps and a total length
that differs from the announced one are errors.  The chunked framing of the joined
block is then decoded.

Null payloads count as empty, in records of their own; rows with equal payloads are
tied by id, and an id is smaller than none.  Each row has a record id of its own: rows
that repeat an id, or have none, are counted by id, URL and payload, and get theirs
from these three and their number.  Control characters and spaces in URLs are
percent-encoded, so that no URL can end a field; null URLs become ``about:blank``.
Columns other than those asked for are ignored, and an empty table gives an empty
archive and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, keyed, remove, settled, shared_path

END = b"\r\n\r\n"
#: Blocks longer than this are cut into segments.
SEGMENT_BYTES = 32_768
#: Bytes of body in one chunk of the transfer coding.
CHUNK_BYTES = 8_192
#: Records in one archive file; with SEGMENT_BYTES it bounds a file that a task reads whole.
FILE_RECORDS = 2_000
#: The WARC date of all records, for archives that do not differ from run to run.
DATE = "2024-01-01T00:00:00Z"
#: Records of equal rows that one task writes.
COPIES = 1_000

RECORD = "id long, kind string, uri string, refers_to string, digest string, origin string, segment int, total long, block binary"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def to_chunks(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [body[i : i + size] for i in range(0, len(body), size)]
    return b"".join([b"%x\r\n%s\r\n" % (len(p), p) for p in parts]) + b"0\r\n\r\n"


def from_chunks(framed: bytes) -> bytes:
    """The body of a chunked message; chunk extensions and trailers are dropped."""
    at, out = 0, []
    while True:
        end = framed.index(b"\r\n", at)
        size = int(framed[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        if framed[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk does not end where its length says")
        out.append(framed[end + 2 : end + 2 + size])
        at = end + 4 + size


def field_value(url: str) -> str:
    """A URL as the value of a field: control characters and spaces percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_name(page: int | None, row: str = "") -> str:
    """The id of a page's record; ``row`` tells apart rows that share a page id."""
    return f"<urn:page:{'' if page is None else page}{':row:' * bool(row)}{row}>"


def records(name: str, uri: str, payload: bytes, refers_to: str | None, segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of one page, without the blank lines after each; ``refers_to`` names the record it revisits."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    fields = {"WARC-Date": DATE, "WARC-Target-URI": field_value(uri), "WARC-Payload-Digest": "sha1:" + payload_digest(payload)}

    def framed(kind: str, own_name: str, block: bytes, **more: object) -> bytes:
        own = {"WARC-Type": kind, "WARC-Record-ID": own_name, **fields, **{k.replace("_", "-"): v for k, v in more.items()}}
        own |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
        return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in own.items()).encode() + b"\r\n" + block

    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield framed("revisit", name, head + b"\r\n", WARC_Profile=profile, WARC_Refers_To=refers_to)
        return
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + to_chunks(payload)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        yield framed("response", name, block)
        return
    yield framed("response", name, parts[0], WARC_Segment_Number=1)
    for n, part in enumerate(parts[1:], 2):
        last = {"WARC_Segment_Total_Length": len(block)} if n == len(parts) else {}
        yield framed("continuation", f"{name[:-1]}:segment:{n}>", part, WARC_Segment_Origin_ID=name, WARC_Segment_Number=n, **last)


def roles(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """key, and refers_key and refers_id of the row with the smallest id of those with an equal payload.

    ``pages`` has columns key, id and payload (binary, not null). Only digests are shuffled,
    and each task's smallest ids alone reach the grouping. A row that is that row itself has
    its own key there; rows of payloads that are too small are left out.
    """
    sums = pages.select("key", "id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size"))
    sums = sums.where(F.col("size") >= min_revisit_bytes)
    first = sums.groupBy("digest", "size").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"))
    return sums.join(first, ["digest", "size"]).select("key", F.col("first.key").alias("refers_key"), F.col("first.id").alias("refers_id"))


def numbered(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows with a ``key`` of their own, and rows of other rows' ids or none: key, and how many ``copies`` of each.

    ``rows`` has columns id, url and payload. The second is None where there are no such rows.
    """
    content = F.struct("url", "payload")
    marked, odd = keyed(rows, "id", content)
    marked = marked.withColumnRenamed("__key", "key")
    if not odd:
        return marked, None
    alone = F.col("id").isNotNull() & (F.col("key") == F.col("id"))
    twins = marked.where(~alone).groupBy("key", "id", "url", "payload").agg(F.count(F.lit(1)).alias("copies"))
    return marked.where(alone), settled(twins)


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    compression: str = "gzip",
) -> None:
    """Write pages as WARC 1.1 files in the folder ``path``, in any store that Spark writes to."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"").cast("binary"))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("about:blank")).alias("url"), payload.alias("payload"))
    rows, twins = numbered(rows)
    first = roles(rows if twins is None else rows.unionByName(twins.drop("copies")), min_revisit_bytes)
    rows = rows.join(first.where("key <> refers_key"), "key", "left").withColumn("start", F.lit(0)).withColumn("stop", F.lit(1))
    if twins is not None:
        chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))).alias("start")
        twins = twins.join(first, "key", "left").select(*twins.columns, "refers_key", "refers_id", chunk)
        twins = twins.withColumn("stop", F.least(F.col("start") + COPIES, "copies")).repartition("key", "start")
        rows = rows.unionByName(twins.drop("copies"))

    def row_name(page, key, at):
        return record_name(page) if key == page else record_name(page, f"{key & (1 << 64) - 1:016x}:{at}")

    def frame(batches):
        for batch in batches:
            out = []
            for page, key, url, body, to_key, to_id, start, stop in zip(*(batch.column(c).to_pylist() for c in ("id", "key", "url", "payload", "refers_key", "refers_id", "start", "stop"))):
                for at in range(start, stop):
                    other = to_key is not None and (to_key != key or at > 0)
                    out.extend(records(row_name(page, key, at), url, body, row_name(to_id, to_key, 0) if other else None, segment_bytes))
                    if len(out) > 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                        out = []
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    framed = rows.mapInArrow(frugal(frame), "value binary").select(F.col("value").cast("string").alias("value"))
    framed.write.option("lineSep", END.decode()).option("maxRecordsPerFile", FILE_RECORDS).option("compression", compression).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (names in lower case) and block of each record of an archive, compressed or not."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)  # any number of members
    at = 0
    while at < len(data):
        end = data.find(END, at)
        if end < 0:
            if data[at:].strip():
                raise ValueError("an archive ends within a record's fields")
            return
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(fields["content-length"])
        begin = end + len(END)
        if begin + size > len(data):
            raise ValueError("an archive ends within a record's block")
        yield fields, data[begin : begin + size]
        at = begin + size
        while data[at : at + 2] == b"\r\n":
            at += 2


def page_number(name: str | None) -> int | None:
    """The page id in a record's name; null for pages without one, and for names of others' making."""
    found = re.fullmatch(r"<urn:page:(-?\d+)(:.*)?>", name or "")
    return int(found[1]) if found else None


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP message, its transfer coding undone."""
    head, _, body = block.partition(END)
    return from_chunks(body) if b"transfer-encoding: chunked" in head.lower() else body


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record of the archives under ``path``, segments apart."""

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields, block in parse(content.as_py()):
                    get = fields.get
                    digest = (get("warc-payload-digest") or "").removeprefix("sha1:") or None
                    origin = get("warc-segment-origin-id") or get("warc-record-id")
                    number = get("warc-segment-number")
                    total = get("warc-segment-total-length")
                    rows.append((page_number(origin), get("warc-type"), get("warc-target-uri"), get("warc-refers-to"), digest, origin, number and int(number), total and int(total), block))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
                columns = list(zip(*rows)) or [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in RECORD.split(", ")])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(frugal(run), RECORD)


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["name", "id", "kind", "uri", "refers_to", "digest", "payload"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            parts = sorted(row["parts"], key=lambda p: p["segment"] or 1)
            if [p["segment"] or 1 for p in parts] != list(range(1, len(parts) + 1)):
                raise ValueError(f"segments of {row['origin']} are missing or repeated")
            block = b"".join(p["block"] for p in parts)
            if len(parts) > 1 and len(block) != parts[-1]["total"]:
                raise ValueError(f"{row['origin']} has {len(block)} bytes, not {parts[-1]['total']}")
            head = parts[0]
            payload = None if head["kind"] == "revisit" else http_payload(block)
            if payload is not None and head["digest"] and payload_digest(payload) != head["digest"]:
                raise ValueError(f"the payload of {row['origin']} does not have its digest")
            rows.append((row["origin"], head["id"], head["kind"], head["uri"], head["refers_to"], head["digest"], payload))
        columns = list(zip(*rows)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: name (the record's id), id, kind, uri, refers_to (the name of the record that
    a revisit repeats), digest and payload (null for revisits).

    Records that were never cut do not pass the shuffle.
    """
    found = read_records(spark, path)
    part = F.struct("segment", "total", "block", "id", "kind", "uri", "refers_to", "digest")
    cut = found.where("segment is not null").groupBy("origin").agg(F.collect_list(part).alias("parts"))
    whole = found.where("segment is null").select("origin", F.array(part).alias("parts"))
    schema = "name string, id long, kind string, uri string, refers_to string, digest string, payload binary"
    return whole.unionByName(cut).mapInArrow(frugal(_reassemble), schema)


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0) -> DataFrame:
    """Write pages to archives in the shared folder, read them back, and describe each page.

    Columns: id, payload_bytes, payload_digest, record_type, refers_to. A revisit's payload
    is that of the record it refers to.
    """
    spark = pages.sparkSession
    path = shared_path(spark, f"warc-{uuid.uuid4().hex}")
    write_warc(pages, path, id_col, url_col, payload_col, min_revisit_bytes)
    read = read_warc(spark, path)
    seen = settled(read.select("name", "id", "kind", "refers_to", F.octet_length("payload").cast("long").alias("bytes"), "digest"))
    remove(spark, path)
    full = seen.where("kind = 'response'")
    again = seen.where("kind = 'revisit'").select("id", F.col("refers_to").alias("name"), "digest")
    origin = full.select("name", F.col("id").alias("refers_to"), "bytes", F.col("digest").alias("origin_digest"))
    same = F.when(F.col("digest") == F.col("origin_digest"), F.col("bytes"))
    again = again.join(origin, "name").select("id", same.alias("bytes"), "digest", F.lit("revisit").alias("kind"), "refers_to")
    full = full.select("id", "bytes", "digest", "kind", F.lit(None).cast("long").alias("refers_to"))
    return full.unionByName(again).select(
        F.col("id").alias(id_col),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
    )
