"""Content-addressed WARC archives.

An archive is two tables. `payloads` holds every distinct payload once, compressed, under
its SHA-256. `headers` holds the exact header block of every record and the address of its
payload. Original records come back from a join on the address; each payload is checked
against its address when it is read. Of equal payloads, the record with the largest key is
the response, the others are revisits of it.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The digits that `conv` writes to base 32, and those of base32 (RFC 4648), fixed values.
_DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BREAK = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base32: four times 40 bits, 8 digits each."""
    digest = F.sha1(payload)
    quarters = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*quarters), _DIGITS, BASE32)


def _record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:x-record:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def _compressed(payloads: DataFrame) -> DataFrame:
    """`payload` as `packed`: deflated, with the other columns kept."""
    names = [c for c in payloads.columns if c != "payload"]

    def deflate(batches):
        for batch in batches:
            packed = [zlib.compress(p, 6) for p in batch.column(len(names)).to_pylist()]
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary())], [*names, "packed"])

    kept = payloads.select(*names, "payload")
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(deflate, f"{types}, packed binary")


def write_archive(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", min_bytes: int = 0) -> None:
    """Write `records` (key long, uri string, payload binary) to a new archive.

    A null payload is empty. Payloads of fewer than `min_bytes` bytes are always responses.
    A null key counts as smaller than any other; rows with the same key and payload are
    records of their own. Line breaks in a URI are escaped, a null URI leaves its line out.
    Copies meet once before the shuffle and once after it, so a payload that a third of all
    records share travels once per task. Two payloads with one SHA-256 but another length
    or SHA-1 are an error.
    """
    rows = records.select(
        F.col("key").cast("long").alias("key"), "uri", F.coalesce("payload", F.lit(b"")).alias("payload")
    )
    address = F.sha2("payload", 256)
    stored = _compressed(rows.select(address.alias("address"), F.octet_length("payload").cast("long").alias("bytes"),
                                     base32_sha1(F.col("payload")).alias("sha1"), "payload"))
    once = stored.groupBy("address").agg(
        F.first("packed").alias("packed"), F.min("bytes").alias("bytes"), F.max("bytes").alias("most"),
        F.min("sha1").alias("sha1"), F.max("sha1").alias("other"),
    )
    clash = (F.col("bytes") != F.col("most")) | (F.col("sha1") != F.col("other"))
    broken = F.raise_error(F.lit("two payloads share one SHA-256")).cast("binary")
    once.select("address", F.when(clash, broken).otherwise(F.col("packed")).alias("packed")).write.option(
        "compression", "none"
    ).parquet(f"{path}/payloads")

    facts = rows.select(
        "key", "uri", address.alias("address"), F.octet_length("payload").cast("long").alias("bytes"),
        base32_sha1(F.col("payload")).alias("sha1"),
    )
    newest = facts.groupBy("address").agg(F.max("key").alias("newest"))
    told = facts.join(newest, "address")
    first = (F.col("bytes") < min_bytes) | F.col("newest").isNull() | F.col("key").eqNullSafe(F.col("newest"))
    uri = F.regexp_replace(F.regexp_replace("uri", "\r", "%0D"), "\n", "%0A")

    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(_BREAK))

    header = F.concat(
        F.lit(f"WARC/1.1{_BREAK}"),
        line("WARC-Type", F.when(first, "response").otherwise("revisit")),
        line("WARC-Record-ID", _record_id(F.col("key"))),
        line("WARC-Date", date),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(first, F.lit("")).otherwise(
            F.concat(line("WARC-Refers-To", _record_id(F.col("newest"))), line("WARC-Profile", REVISIT_PROFILE))
        ),
        line("Content-Type", "text/html; charset=UTF-8"),
        line("Content-Length", F.when(first, F.col("bytes")).otherwise(F.lit(0)).cast("string")),
        F.lit(_BREAK),
    )
    told.select("address", header.alias("header")).write.parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload) of every record; revisits come with the payload they refer to.

    A payload that does not match its address is an error, and so is one that is missing.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    joined = headers.join(payloads, "address", "left").select("address", "header", "packed")

    def inflate(batches):
        for batch in batches:
            found = []
            for address, packed in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if packed is None:
                    raise ValueError(f"no payload {address}")
                payload = zlib.decompress(packed)
                if hashlib.sha256(payload).hexdigest() != address:
                    raise ValueError(f"payload {address} is damaged")
                found.append(payload)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary())], ["header", "payload"])

    return joined.mapInArrow(inflate, "header string, payload binary")


def field(name: str) -> Column:
    """A header field of a record, null if it has none."""
    return F.nullif(F.regexp_extract("header", rf"(?md)^{name}: (.*?)\r$", 1), F.lit(""))


def record_number(name: str) -> Column:
    """The key in a field that holds a record id."""
    return F.nullif(F.regexp_extract("header", rf"(?md)^{name}: <urn:x-record:(-?\d*)>\r$", 1), F.lit("")).cast("long")


def whole_records(archive: DataFrame) -> DataFrame:
    """The original bytes of every record: its header, its block and two line breaks. The
    block of a revisit is empty."""
    block = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return archive.select(F.concat(F.col("header").cast("binary"), block, F.lit(b"\r\n\r\n")).alias("record"))


def described(archive: DataFrame) -> DataFrame:
    """key, payload_bytes, payload_digest, record_type and refers_to of every record, the
    size and digest taken from the payload itself."""
    return archive.select(
        record_number("WARC-Record-ID").alias("key"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        record_number("WARC-Refers-To").alias("refers_to"),
    )
