"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Archives are read in splits. The bytes between two occurrences of the version line are a piece;
each occurrence may begin a record, or may lie inside a payload that happens to contain it. A
task gives every candidate the offset at which its successor would begin, by the lengths in its
header. Only what the chain of successors from the start of the file reaches is a record. The
chain is followed by pointer jumping: inside a split in numpy, between splits by joins that
double the distance in every round.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_marts.sources import scratch_copy

MARK = "WARC/1."  # of every record; files are split at it
VERSIONS = (b"0\r\n", b"1\r\n")  # what ends the version line
END = "\r\n\r\n"  # of a header, and of a record
RECORD_URN = "urn:x-record:"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed values of RFC 4648


def base32_of_hex(digits: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hex: five hex digits are four base32 digits."""
    parts = [
        F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def write_warc(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html",
    min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """One record per row in uncompressed archives below ``path``, which must not exist.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the largest key is a
    ``response`` record; the others are ``revisit`` records that refer to it and hold the HTTP
    head alone, which tells the payload's length. Smaller payloads are all responses.

    A null body is an empty payload. A row with a null key never is the one referred to, unless
    all rows of its payload have null keys; those then are responses. Rows that repeat the
    largest key are responses each. Null urls have no target; line breaks in a url become %0D%0A.
    Other columns are ignored; an empty table gives archives without records.

    The payloads are shuffled only where the list of repeated payloads is too long for Spark to
    broadcast by its own threshold.
    """
    payload = F.coalesce(F.col(body), F.lit(""))
    rows = pages.select(
        F.col(key).cast("string").alias("_key"), F.col(key).alias("_order"), F.col(url).alias("_url"),
        payload.alias("_body"), F.sha1(payload.cast("binary")).alias("_sha1"),
        F.octet_length(payload).alias("_bytes"),
    )
    repeated = rows.where(F.col("_bytes") >= min_bytes).groupBy("_sha1").agg(
        F.max("_order").cast("string").alias("_refers"), F.count(F.lit(1)).alias("_n")
    )
    repeated = scratch_copy(repeated.where("_n > 1 and _refers is not null").drop("_n"), "payloads")
    rows = rows.join(repeated, "_sha1", "left")
    revisit = F.coalesce(
        F.col("_refers").isNotNull() & ~F.col("_refers").eqNullSafe(F.col("_key"))
        & (F.col("_bytes") >= min_bytes), F.lit(False),
    )
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("_bytes").cast("string"), F.lit(END),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("_body")))
    urn = lambda c: F.concat(F.lit(f"<{RECORD_URN}"), c, F.lit(">\r\n"))
    target = F.regexp_replace(F.regexp_replace("_url", "\r", "%0D"), "\n", "%0A")
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        F.when(revisit, F.lit("WARC-Type: revisit\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        F.lit("WARC-Record-ID: "), urn(F.coalesce("_key", F.lit("null"))),
        F.lit(f"WARC-Date: {date}\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), target, F.lit("\r\n")), F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"), base32_of_hex(F.col("_sha1")), F.lit("\r\n"),
        F.when(revisit, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
            F.lit("WARC-Refers-To: "), urn(F.col("_refers")),
        )).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END), block,
    )
    rows.select(record).write.option("lineSep", END).text(path)


_CANDIDATE = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("at", T.LongType()),  # of the version line, from the first one of the split
    T.StructField("size", T.LongType()),  # of version line and piece
    T.StructField("length", T.LongType()),  # of the record by its header, null if it has none
    T.StructField("record_type", T.StringType()),
    T.StructField("record_id", T.StringType()),
    T.StructField("refers_to", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("declared_digest", T.StringType()),
])


def _fields(head: bytes) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n"))
    return {name.strip().lower(): value.strip() for name, sep, value in pairs if sep}


def _record_id(value: bytes | None) -> str | None:
    found = re.fullmatch(rb"<(?:" + RECORD_URN.encode() + rb")?(.*)>", value or b"")
    name = found[1].decode("utf-8", "replace") if found else None
    return None if name == "null" else name


def parse_record(piece: bytes) -> dict:
    """Fields of the record of whose version line ``piece`` is the end; the payload may be cut."""
    if piece[:3] not in VERSIONS:
        return {}
    head, blank, rest = piece[3:].partition(END.encode())
    fields = _fields(head)
    length = fields.get(b"content-length", b"")
    if not blank or not length.isdigit() or len(length) > 15:
        return {}
    record = {
        "length": len(MARK) + 3 + len(head) + 2 * len(END) + int(length),
        "record_type": fields.get(b"warc-type", b"").decode("utf-8", "replace"),
        "record_id": _record_id(fields.get(b"warc-record-id")),
        "refers_to": _record_id(fields.get(b"warc-refers-to")),
        "url": fields[b"warc-target-uri"].decode("utf-8", "replace") if b"warc-target-uri" in fields else None,
        "declared_digest": fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha1:") or None,
    }
    block = rest[: int(length)]
    http, blank, payload = block.partition(END.encode())
    if not (blank and fields.get(b"content-type", b"").startswith(b"application/http")):
        http, payload = b"", block
    record["payload"] = payload
    if record["record_type"] == "revisit":
        stated = _fields(http).get(b"content-length", b"")
        record["payload_bytes"] = int(stated) if stated.isdigit() and len(stated) < 16 else None
        record["payload_digest"] = record["declared_digest"]
    else:
        record["payload_bytes"] = len(payload)
        record["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return record


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between the marks of records, in file order within a split."""
    text = spark.read.option("lineSep", MARK).text(path)
    return text.select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, block, at, piece): the first piece of a file precedes its first version line."""
    split, at = None, 0
    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        for file, block, value in zip(files, blocks, batch.column("value"), strict=True):
            if (file, block) != split:
                split, at = (file, block), -len(MARK) if block == 0 else 0
            piece = value.as_py()
            if block == 0 and (at < 0 < len(piece) or at == 0 and piece[:3] not in VERSIONS):
                raise ValueError(f"{file} does not begin as a WARC/1.0 or WARC/1.1 file")
            yield file, block, at, piece
            at += len(MARK) + len(piece)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for f in _CANDIDATE])
    rows: list[dict] = []
    for file, block, at, piece in _numbered(batches):
        row = {"file": file, "block": block, "at": at, "size": len(MARK) + len(piece)}
        rows.append(row | (parse_record(piece) if at >= 0 else {}))
        rows[-1].pop("payload", None)
        if len(rows) == 10_000:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows = []
    yield pa.RecordBatch.from_pylist(rows, schema)


def _leave_split(rows: pd.DataFrame) -> pd.DataFrame:
    """Where the chain from each candidate of a split arrives outside of it (-1: nowhere)."""
    rows = rows.sort_values("offset")
    offset, after = rows["offset"].to_numpy(), rows["next"].fillna(-1).to_numpy(np.int64)
    place = np.searchsorted(offset, after)
    inside = (place < len(offset)) & (offset[np.minimum(place, len(offset) - 1)] == after)
    jump = np.where(inside, place, np.arange(len(offset)))
    while not np.array_equal(jump, jump[jump]):
        jump = jump[jump]
    arrives = np.where((after[jump] > offset[-1]), after[jump], -1)
    return pd.DataFrame({"file": rows["file"], "offset": offset, "arrives": arrives})


def _follow(rows: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a split that the chain through its entry reaches."""
    rows = rows.sort_values("offset")
    offset, after = rows["offset"].to_numpy(), rows["next"].fillna(-1).to_numpy(np.int64)
    keep, at = [], rows["entry"].iloc[0]
    while True:
        place = int(np.searchsorted(offset, at))
        if place == len(offset) or offset[place] != at:
            break
        keep.append(place)
        if after[place] <= at:
            break
        at = after[place]
    return rows.iloc[keep][["file", "block", "offset"]]


def _chain(candidates: DataFrame) -> DataFrame:
    """``file``, ``block``, ``offset`` of the records among ``candidates`` (with ``next``)."""
    narrow = candidates.select("file", "block", "offset", "next")
    leaves = narrow.groupBy("file", "block").applyInPandas(
        _leave_split, "file string, offset long, arrives long"
    )
    begins = narrow.select("file").distinct().withColumn("offset", F.lit(0).cast("long"))
    jumps = scratch_copy(leaves.where("arrives >= 0").select("file", "offset", "arrives"), "jumps")
    # only places that some chain arrives at, or file starts, can be entries of a split
    entries = jumps.select("file", F.col("arrives").alias("offset")).unionByName(begins).distinct()
    jumps = scratch_copy(jumps.join(entries, ["file", "offset"]), "jumps")
    reached = begins
    while not jumps.isEmpty():
        further = reached.join(jumps, ["file", "offset"]).select("file", F.col("arrives").alias("offset"))
        reached = scratch_copy(reached.unionByName(further).distinct(), "reached")
        onward = jumps.select("file", F.col("offset").alias("arrives"), F.col("arrives").alias("_to"))
        jumps = jumps.join(onward, ["file", "arrives"])
        jumps = scratch_copy(jumps.select("file", "offset", F.col("_to").alias("arrives")), "jumps")
    entered = narrow.join(reached, ["file", "offset"]).groupBy("file", "block").agg(F.min("offset").alias("entry"))
    return narrow.join(entered, ["file", "block"]).groupBy("file", "block").applyInPandas(
        _follow, "file string, block long, offset long"
    )


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Records of uncompressed WARC files of version 1.0 or 1.1, whatever their payloads contain.

    Returns ``file``, ``offset``, ``record_type``, ``record_id`` and ``refers_to`` (without the
    URN prefix that :func:`write_warc` gives them), ``url``, ``payload_bytes``,
    ``payload_digest`` (SHA-1 in base32, computed from the payload read; of a revisit record the
    stated one), ``intact`` (the stated digest is missing or right) and, if asked for,
    ``payload``. A header without its blank line or without a length ends the chain of its file:
    what follows isn't reachable and isn't returned. Empty files have no records; any other file
    that does not begin with a version line is an error.

    A record that holds version lines in its payload lies in several pieces; these are gathered
    for the digest, and are the only payloads that move between tasks unless ``payload`` is set.
    One split's candidates must fit in a task, so must one record, and so must the offsets of one
    file's pieces that are no whole records.
    """
    found = scratch_copy(_pieces(spark, path).mapInArrow(_candidates, _CANDIDATE), "candidates")
    # the split that begins at 0 starts with what precedes its first version line
    ends = found.groupBy("file", "block").agg(F.max(F.col("at") + F.col("size")).alias("_size"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select("file", "block", F.sum("_size").over(earlier).alias("_base"))
    candidates = found.where("at >= 0").join(base, ["file", "block"], "left")
    candidates = candidates.withColumn("offset", F.col("at") + F.coalesce("_base", F.lit(0)))
    candidates = candidates.withColumn("next", F.col("offset") + F.col("length")).drop("_base")
    candidates = scratch_copy(candidates, "candidates")
    chain = scratch_copy(_chain(candidates), "chain")
    records = candidates.join(chain, ["file", "block", "offset"])

    # pieces that belong to a record in several pieces: its own and the unreachable ones within
    whole = F.col("next") == F.col("offset") + F.col("size")
    marked = candidates.join(chain.withColumn("_in", F.lit(True)), ["file", "block", "offset"], "left")
    loose = marked.where(F.col("_in").isNull() | ~whole).withColumn("piece", F.col("offset"))
    head = F.when(F.col("_in"), F.struct("offset", "next"))
    owner = F.last(head, ignorenulls=True).over(Window.partitionBy("file").orderBy("offset"))
    parts = loose.withColumn("_o", owner).where("piece < _o.next")
    parts = parts.select("file", "block", "at", "piece", F.col("_o.offset").alias("owner"))
    if payload:
        alone = records.where(whole).select("file", "block", "at", F.col("offset").alias("piece"), F.col("offset").alias("owner"))
        parts = alone.unionByName(parts)
    parts = scratch_copy(parts, "parts")

    def texts(batches):
        schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("value", pa.binary())])
        for row in _numbered(batches):
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True))], schema)

    @F.udf("payload binary, payload_bytes long, payload_digest string")
    def joined(pieces):
        record = parse_record(MARK.encode().join(bytes(p["value"]) for p in sorted(pieces, key=lambda p: p["piece"])))
        return record["payload"], record["payload_bytes"], record["payload_digest"]

    out = ["file", "offset", "record_type", "record_id", "refers_to", "url", "payload_bytes", "payload_digest"]
    intact = F.col("declared_digest").isNull() | (F.col("declared_digest") == F.col("payload_digest"))
    plain = records.where(whole) if not payload else records.limit(0)
    plain = plain.withColumn("payload", F.lit(None).cast("binary"))
    if not payload and parts.isEmpty():
        return plain.select(*out, intact.alias("intact"))
    moved = _pieces(spark, path).mapInArrow(texts, "file string, block long, at long, value binary")
    moved = moved.join(parts, ["file", "block", "at"]).groupBy("file", "owner").agg(
        joined(F.collect_list(F.struct("piece", "value"))).alias("_r")
    )
    moved = moved.select("file", F.col("owner").alias("offset"), "_r.*")
    gathered = records.drop("payload_bytes", "payload_digest").join(moved, ["file", "offset"])
    records = plain.select(*out, "declared_digest", "payload").unionByName(
        gathered.select(*out, "declared_digest", "payload")
    )
    return records.select(*out, intact.alias("intact"), *(["payload"] if payload else []))
