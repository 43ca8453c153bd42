"""WARC archives: written through Spark's text sink, read back by boundary-chain verification.

Writing: one record per row, each closed by an empty line pair, in as many
archive files as there are write tasks.  Of the rows with equal payloads the
one with the largest key is a ``response`` record with the full payload; the
others are ``revisit`` records without payload that refer to it.

Reading: archives are plain byte streams, and a payload may hold the magic
string itself.  Spark's text source splits the files at every magic string
into blocks; tasks emit, for each candidate, its offset and the offset of its
successor (from its Content-Length).  Pointer jumping from offset 0 of each
file keeps the candidates on the chain of true records and drops all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smogmesh.llm.common import drop_written, shuffles_removed
from smogmesh.llm.common import tidily_written as written

MAGIC = "WARC/1.1\r\n"
_END = "\r\n\r\n"
#: Digests of repeated payloads, or places of torn records and of the false magic strings in
#: them (some 60 to 200 bytes each), that may be sent to every task.
BROADCAST_ROWS = 250_000


def _base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a 40-digit hex SHA-1: eight groups of five digits, four characters each."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    chars = []
    for g in range(8):
        value = F.conv(F.substring(hex_digest, 5 * g + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1
            chars.append(F.substring(alphabet, at, F.lit(1)))
    return F.concat(*chars)


def _header(name: str, value: Column) -> Column:
    """``Name: value`` line; control characters and blanks at the ends never break a header."""
    clean = F.trim(F.regexp_replace(value.cast("string"), r"[\x00-\x1F\x7F]+", " "))
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n"))).otherwise(F.lit(""))


def write_archives(pages: DataFrame, path: str, *, key: str = "page_id", payload: str = "html", url: str = "url") -> None:
    """Write one WARC record per row of ``pages`` below ``path``.

    The payload of a null is empty.  Rows with a null key have no record ID
    and count as smaller than any other key; repeated rows (same key, same
    payload) are all responses.  An empty table gives an archive without
    records.  Columns other than key, payload and url are ignored.  The HTTP message in
    a response record has a minimal head; the payload is the entity body.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(key).alias("_k"),
        F.col(url).cast("string").alias("_url"),
        body.alias("_body"),
        F.sha1(body.cast("binary")).alias("_s"),
    )
    # Only payloads that occur again need to know of each other; bodies meet their table without
    # a shuffle as long as it is small.
    many = rows.groupBy("_s").agg(F.max("_k").alias("_best"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    many = written(many, "warc-best")
    rows = rows.join(F.broadcast(many) if many.count() <= BROADCAST_ROWS else many, "_s", "left")
    size = F.octet_length(F.col("_body").cast("binary")).cast("long")
    is_response = F.col("_n").isNull() | F.col("_k").eqNullSafe(F.col("_best"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        size.cast("string"),
        F.lit(_END),
    )
    block = F.when(is_response, F.concat(http, F.col("_body"))).otherwise(F.lit(""))
    head = F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.when(is_response, "response").otherwise("revisit")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("_k").cast("string"), F.lit("")), F.lit(">"))),
        _header("WARC-Target-URI", F.col("_url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), _base32(F.col("_s")))),
        _header("X-Payload-Length", size),
        _header(
            "WARC-Refers-To",
            F.when(~is_response, F.concat(F.lit("<urn:page:"), F.col("_best").cast("string"), F.lit(">"))),
        ),
        _header("Content-Type", F.when(is_response, "application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(F.col("_block").cast("binary")).cast("long")),
        F.lit("\r\n"),
    )
    rows = rows.withColumn("_block", block)
    with shuffles_removed(pages.sparkSession):
        rows.select(F.concat(head, F.col("_block")).alias("value")).write.option("lineSep", _END).text(path)


# -- reading ---------------------------------------------------------------------

def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at every magic string: raw bytes, file and start of the input block."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _block_starts(chunks: DataFrame) -> DataFrame:
    """Offset at which each block's first chunk begins: sums over the blocks before it.

    One row per input block of a file (tens of megabytes each), so the window
    over a file's blocks is tiny.
    """
    sizes = chunks.groupBy("file", "block").agg(
        F.sum(F.octet_length("value").cast("long") + len(MAGIC)).alias("n")
    )
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("file", "block", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("start"))


def parse_head(chunk: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields (lower-case names) and length of the header block, however long, that opens ``chunk``."""
    end = chunk.find(_END.encode())
    if end < 0:
        return None
    fields = {}
    for line in chunk[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields, end + len(_END)


def _with_offsets(rows: Iterator[pa.RecordBatch]):
    """(file, block, offset of the magic string before the chunk relative to the block, chunk) in file order."""
    at, here = None, 0
    for batch in rows:
        files, blocks, values = batch.column("file"), batch.column("block"), batch.column("value")
        for i in range(batch.num_rows):
            f, b, chunk = files[i].as_py(), blocks[i].as_py(), values[i].as_py()
            if (f, b) != at:
                at, here = (f, b), 0
            yield f, b, here - len(MAGIC), chunk
            here += len(chunk) + len(MAGIC)


def candidates(spark: SparkSession, path: str, starts: DataFrame) -> DataFrame:
    """(file, off, next, size): each magic string, the successor its header announces, its chunk's size.

    ``next`` is null if what follows the magic string is no header with a
    Content-Length.  A file's first chunk, before any magic string, is empty
    and has no candidate.
    """

    def find(rows):
        out: dict[str, list] = {"file": [], "block": [], "rel": [], "step": [], "size": []}
        for f, b, rel, chunk in _with_offsets(rows):
            head = parse_head(chunk)
            step = None
            if head:
                length = head[0].get("content-length", "")
                if length.isascii() and length.isdigit():
                    step = len(MAGIC) + head[1] + int(length) + len(_END)
            for k, v in zip(out, (f, b, rel, step, len(chunk))):
                out[k].append(v)
            if len(out["file"]) >= 5000:
                yield pa.RecordBatch.from_pydict(out, schema=schema)
                out = {k: [] for k in out}
        yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema(
        [("file", pa.string()), ("block", pa.int64()), ("rel", pa.int64()), ("step", pa.int64()), ("size", pa.int64())]
    )
    found = _chunks(spark, path).mapInArrow(find, "file string, block long, rel long, step long, size long")
    return (
        found.join(starts, ["file", "block"])
        .select("file", (F.col("rel") + F.col("start")).alias("off"), "step", "size")
        .filter("off >= 0")
        .select("file", "off", (F.col("off") + F.col("step")).alias("next"), "size")
    )


def chain(found: DataFrame) -> DataFrame:
    """(file, off) of the candidates reachable from offset 0 of their file, by pointer jumping.

    Round k knows the first 2**k records of every chain and each candidate's
    2**k-th successor; both double, so the rounds grow with the logarithm of
    the records in a file.  Every round is a written table.
    """
    jump = written(found.select("file", "off", F.col("next").alias("to")).filter("to is not null"), "warc-jump")
    known = written(found.filter("off = 0").select("file", "off"), "warc-known")
    while True:
        ahead = known.join(jump, ["file", "off"]).select("file", F.col("to").alias("off"))
        ahead = written(ahead.join(found.select("file", "off"), ["file", "off"], "left_semi"), "warc-ahead")
        if ahead.isEmpty():
            drop_written(jump)
            return known
        before, known = known, written(known.unionByName(ahead), "warc-known")
        drop_written(before, ahead)
        hop = jump.select("file", F.col("off").alias("to"), F.col("to").alias("to2"))
        before, jump = jump, written(jump.join(hop, ["file", "to"]).select("file", "off", F.col("to2").alias("to")), "warc-jump")
        drop_written(before)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The verified records: ``file, off, headers map, payload binary`` (payload null for revisits).

    A payload that holds the magic string was cut into several chunks; they
    are put together again, in order, for that record only.  All other chunks
    are records as they stand: their bodies are not shuffled as long as the
    table of the cut ones is small.
    """
    starts = written(_block_starts(_chunks(spark, path)), "warc-starts")
    found = written(candidates(spark, path, starts), "warc-candidates")
    true = chain(found)
    # The record that each chunk belongs to: the last real one at or before it.
    # Only chunks after a false magic string need it; all others are records.
    fake = found.join(true, ["file", "off"], "left_anti").select("file", "off")
    spans = found.join(true, ["file", "off"]).select("file", F.col("off").alias("rec"), "next", "size")
    # A real record whose own chunk is shorter than announced goes on behind false magic strings.
    torn = spans.filter(F.col("next") - F.col("rec") - len(MAGIC) > F.col("size")).select("file", "rec", "next")
    parts = fake.join(_owners(fake, torn), ["file", "off"], "left")
    cut = written(torn.select("file", F.col("rec").alias("off"), "rec").unionByName(parts), "warc-cut")
    n_cut = cut.count()
    drop_written(found, true)

    def place(rows):
        out: dict[str, list] = {"file": [], "block": [], "rel": [], "value": []}
        size = 0
        for f, b, rel, chunk in _with_offsets(rows):
            for k, v in zip(out, (f, b, rel, chunk)):
                out[k].append(v)
            size += len(chunk)
            if size > 4 << 20:
                yield pa.RecordBatch.from_pydict(out, schema=schema)
                out, size = {k: [] for k in out}, 0
        yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("rel", pa.int64()), ("value", pa.binary())])
    placed = _chunks(spark, path).mapInArrow(place, "file string, block long, rel long, value binary")
    placed = placed.join(starts, ["file", "block"]).select("file", (F.col("rel") + F.col("start")).alias("off"), "value")
    rows = placed.filter("off >= 0").withColumn("more", F.lit(None).cast("array<binary>"))
    if n_cut:
        known = F.broadcast(cut) if n_cut <= BROADCAST_ROWS else cut
        pieces = (
            placed.join(known.filter("rec is not null"), ["file", "off"])
            .groupBy("file", F.col("rec").alias("off"))
            .agg(F.array_sort(F.collect_list(F.struct("off", "value"))).alias("all"))
            .filter(F.size("all") > 1)
            .select("file", "off", F.col("all.value").alias("all"))
        )
        torn_records = pieces.select("file", "off", F.get("all", 0).alias("value"), F.slice("all", 2, F.size("all") - 1).alias("more"))
        rows = rows.join(known, ["file", "off"], "left_anti").unionByName(torn_records)

    def parse(batches):
        out_schema = pa.schema(
            [("file", pa.string()), ("off", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
        )
        for batch in batches:
            rows_out = []
            for r in batch.to_pylist():
                data = MAGIC.encode().join([r["value"], *(r["more"] or [])])
                fields, start = parse_head(data)
                block = data[start : start + int(fields["content-length"])]
                payload = None
                if fields.get("warc-type") == "response":
                    payload = block[block.find(_END.encode()) + len(_END) :]
                rows_out.append({"file": r["file"], "off": r["off"], "headers": list(fields.items()), "payload": payload})
            yield pa.RecordBatch.from_pylist(rows_out, schema=out_schema)

    return rows.mapInArrow(parse, "file string, off long, headers map<string,string>, payload binary")


def _owners(fake: DataFrame, torn: DataFrame) -> DataFrame:
    """(file, off, rec): the torn record whose span holds each false magic string.

    Spans do not overlap, so the owner is the last torn start before the
    string: a union in offset order with the latest start carried forward,
    per file.  Only false strings and torn records take part.
    """
    both = fake.select("file", "off", F.lit(None).cast("long").alias("rec"), F.lit(None).cast("long").alias("stop")).unionByName(
        torn.select("file", F.col("rec").alias("off"), "rec", F.col("next").alias("stop"))
    )
    w = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.select(
        "file",
        "off",
        F.col("rec").isNull().alias("_fake"),
        F.last("rec", ignorenulls=True).over(w).alias("rec"),
        F.last("stop", ignorenulls=True).over(w).alias("stop"),
    )
    return filled.filter("_fake and rec is not null and off < stop").select("file", "off", "rec")


def archive_index(records: DataFrame) -> DataFrame:
    """One row per verified record: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    For responses, length and digest are those of the payload as read back;
    revisits carry the full payload's in their headers.
    """
    head = lambda n: F.col("headers")[n]
    ident = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1)
    own = F.col("payload").isNotNull()
    return records.select(
        F.when(ident(head("warc-record-id")) != "", ident(head("warc-record-id"))).cast("long").alias("page_id"),
        F.when(own, F.octet_length("payload").cast("long")).otherwise(head("x-payload-length").cast("long")).alias("payload_bytes"),
        F.when(own, _base32(F.sha1("payload"))).otherwise(F.substring(head("warc-payload-digest"), 6, 32)).alias("payload_digest"),
        head("warc-type").alias("record_type"),
        F.when(~own, ident(head("warc-refers-to")).cast("long")).alias("refers_to"),
    )
