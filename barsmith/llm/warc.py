"""WARC archives in zstandard: one frame per record, dictionary in the leading skippable frame.

Writing: rows become WARC/1.1 records. Of records with equal payloads of at least
``min_bytes`` bytes the one with the smallest id is a response; the others are revisits
that name it and carry no payload. A task fills an archive up to ``archive_bytes`` of
records, makes a dictionary of a bounded sample of that archive's records (``sample_bytes``, ``excerpt_bytes`` of
each; trained, or raw content where there are too few to train on), and emits
the archive as one row (name, content): a skippable frame with the dictionary, then one
frame per record. The rows are a Parquet table in the shared folder, so any file system
that Spark writes to will do, and a lost executor only repeats its tasks.

Reading: ``read_archives`` takes such rows, ``open_archives`` files of the same format by
Spark's binaryFile source. The dictionary is loaded from the leading frame (plain, or itself
compressed), frames are decoded one at a time, and each record's version line, named
fields, Content-Length, block end and SHA-1 digests are checked. What is wrong is told in
the column ``problem``, null for a valid record; ``strict`` raises instead. A damaged frame
ends its archive with one row of problem, as no later frame can be found.

Null payloads are empty ones. Null ids get a name from their payload's digest, are never the
smallest, and revisit the smallest of the others if there is one. Rows that repeat the
smallest id with an equal payload are responses too. Payloads of any length are one record, which a task
holds whole. Null URLs leave the field out; line
ends in a URL are percent-encoded. Empty tables give no archive and no record. Extra
columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
from typing import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm.common import stored

# The formats' magic numbers and names.
DICTIONARY_MAGIC = (0x184D2A5D).to_bytes(4, "little")
ZSTD_MAGIC = (0xFD2FB528).to_bytes(4, "little")
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Record-ID", "WARC-Type", "WARC-Date", "Content-Length")

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD_SCHEMA = ("archive string, record_id string, record_type string, target_uri string, payload_digest string, "
                 "payload_bytes long, refers_to string, payload binary, problem string")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(name: str, kind: str, uri: str | None, date: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    block = HTTP + payload if kind == "response" else HTTP
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date)]
    if uri is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\r\n]", lambda m: quote(m[0]), uri)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    fields += [("WARC-Payload-Digest", "sha1:" + digest), ("WARC-Block-Digest", "sha1:" + base32_sha1(block)),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def dictionary_of(records: list[bytes], dictionary_bytes: int, sample_bytes: int, excerpt_bytes: int) -> zstandard.ZstdCompressionDict:
    """A dictionary trained on every n-th record, ``sample_bytes`` in all and ``excerpt_bytes`` of each.
    Records that can't be trained on (too few, or too much alike) are a dictionary as they stand: raw content,
    the first of them at its end, where matches are cheapest."""
    step = max(1, sum(min(len(r), excerpt_bytes) for r in records) // sample_bytes)
    sample = [r[:excerpt_bytes] for r in records[::step]]
    try:
        return zstandard.train_dictionary(dictionary_bytes, sample)
    except zstandard.ZstdError:
        raw = b"".join(reversed([r[:dictionary_bytes] for r in sample[:64]]))[-dictionary_bytes:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def pack_archive(records: list[bytes], dictionary_bytes: int, sample_bytes: int, level: int, excerpt_bytes: int = 1 << 17) -> bytes:
    """The dictionary in the leading skippable frame, then a frame per record."""
    dictionary = dictionary_of(records, dictionary_bytes, sample_bytes, excerpt_bytes)
    content = zstandard.compress(dictionary.as_bytes())
    frame = zstandard.ZstdCompressor(level=level, write_checksum=True, dict_data=dictionary).compress
    return b"".join([DICTIONARY_MAGIC + len(content).to_bytes(4, "little") + content, *map(frame, records)])


def frames(archive: bytes) -> Iterator[bytes]:
    """The content of each frame; raises ValueError or ZstdError where the archive is damaged."""
    view, at, with_dict = memoryview(archive), 0, {}
    if archive[:4] == DICTIONARY_MAGIC:
        at = 8 + int.from_bytes(archive[4:8], "little")
        content = archive[8:at]
        if len(content) < at - 8:
            raise ValueError("the dictionary frame is cut off")
        if content[:4] == ZSTD_MAGIC:
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        with_dict = {"dict_data": zstandard.ZstdCompressionDict(content)}
    decoder = zstandard.ZstdDecompressor(**with_dict)
    while at < len(archive):
        if (int.from_bytes(archive[at:at + 4], "little") & 0xFFFFFFF0) == 0x184D2A50:  # any skippable frame
            at += 8 + int.from_bytes(archive[at + 4:at + 8], "little")
            continue
        one, parts = decoder.decompressobj(), []
        while not one.eof:
            if at >= len(archive):
                raise ValueError("the last frame is cut off")
            piece = view[at:at + 16384]
            parts.append(one.decompress(piece))
            at += len(piece) - len(one.unused_data)
        yield b"".join(parts)


def parse(raw: bytes) -> dict:
    """The fields of RECORD_SCHEMA after ``archive`` for one record."""
    out = dict.fromkeys(("record_id", "record_type", "target_uri", "payload_digest", "payload_bytes", "refers_to", "payload", "problem"))
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        return out | {"problem": "no WARC/1.1 header"}
    fields: dict[str, str] = {}
    for line in lines[1:]:
        k, colon, v = line.decode("utf-8", "replace").partition(":")
        if not colon or not k or k != k.strip():
            return out | {"problem": f"not a named field: {line[:80]!r}"}
        fields[k.lower()] = v.strip()
    if missing := [k for k in REQUIRED if k.lower() not in fields]:
        return out | {"problem": "missing " + ", ".join(missing)}
    bare = lambda k: fields[k].strip("<>") if k in fields else None
    out |= {"record_id": bare("warc-record-id"), "record_type": fields["warc-type"], "target_uri": fields.get("warc-target-uri"),
            "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, "refers_to": bare("warc-refers-to")}
    length = fields["content-length"]
    if not length.isdecimal() or int(length) + 4 != len(rest) or rest[int(length):] != b"\r\n\r\n":
        return out | {"problem": f"Content-Length {length} and end, but {len(rest)} bytes follow"}
    block = rest[:int(length)]
    if fields.get("warc-block-digest", "sha1:" + (own := base32_sha1(block))) != "sha1:" + own:
        return out | {"problem": "the block's digest differs"}
    if out["record_type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
        out |= {"payload": payload, "payload_bytes": len(payload)}
        if out["payload_digest"] not in (None, base32_sha1(payload)):
            return out | {"problem": "the payload's digest differs"}
    elif out["record_type"] == "revisit" and out["refers_to"] is None:
        return out | {"problem": "a revisit without WARC-Refers-To"}
    return out


def write_archives(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = 8 << 20,
                   dictionary_bytes: int = 32 << 10, sample_bytes: int = 1 << 20, excerpt_bytes: int = 1 << 17, level: int = 3) -> DataFrame:
    """(archive, content): the archives of all rows, stored in the shared folder."""
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))
    same = (rows.select("id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n"))
            .filter(F.col("n") >= min_bytes)
            .groupBy("digest", "n").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")))
    # Only payloads that occur again; mostly a small table, joined as its stored size allows.
    same = stored(same.filter("copies > 1 and first is not null").select("digest", "n", "first"), "warc-copies")
    marked = (rows.withColumn("digest", F.sha1("payload")).withColumn("n", F.octet_length("payload"))
              .join(same, ["digest", "n"], "left")
              .select(F.col("id").cast("string").alias("id"), "url", "payload",
                      F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first")).cast("string").alias("refers_to")))

    def write(batches):
        part, number = TaskContext.get().partitionId(), 0

        def emit(records):
            return pa.RecordBatch.from_arrays(
                [pa.array([f"part-{part:06d}-{number:05d}.warc.zst"]),
                 pa.array([pack_archive(records, dictionary_bytes, sample_bytes, level, excerpt_bytes)], pa.binary())], names=["archive", "content"])

        records, size = [], 0
        for b in batches:
            for id_, uri, body, first in zip(*(c for c in b.columns), strict=True):
                id_, uri, body, first = id_.as_py(), uri.as_py(), body.as_py(), first.as_py()
                digest = base32_sha1(body)
                name = "urn:page:" + quote(id_, safe="-") if id_ is not None else "urn:sha1:" + digest
                kind, to = ("response", None) if first is None else ("revisit", "urn:page:" + quote(first, safe="-"))
                records.append(record(name, kind, uri, date, body, digest, to))
                size += len(records[-1])
                if size >= archive_bytes:
                    yield emit(records)
                    records, size, number = [], 0, number + 1
        if records:
            yield emit(records)

    return stored(marked.mapInArrow(write, "archive string, content binary"), "warc-archives")


def open_archives(spark: SparkSession, path: str) -> DataFrame:
    """(archive, content) of the .warc.zst files under ``path``, on any store that Spark reads."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true").load(path)
            .select(F.col("path").alias("archive"), "content"))


def read_archives(archives: DataFrame, *, strict: bool = False, with_payload: bool = True) -> DataFrame:
    """One row per record (RECORD_SCHEMA); ``payload`` is null without ``with_payload``."""

    def rows(batches):
        schema = pa.schema([("archive", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
                            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.string()),
                            ("payload", pa.binary()), ("problem", pa.string())])
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                out, size = [], 0
                try:
                    for raw in frames(content.as_py() or b""):
                        out.append(parse(raw) | {"archive": name} | ({} if with_payload else {"payload": None}))
                        size += len(raw) if with_payload else 200
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema=schema)
                            out, size = [], 0
                        if strict and out and out[-1]["problem"]:
                            raise ValueError(out[-1]["problem"])
                except (ValueError, zstandard.ZstdError) as e:
                    if strict:
                        raise ValueError(f"{name}: {e}") from e
                    out.append({"archive": name, "problem": str(e)})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

    return archives.select("archive", "content").mapInArrow(rows, RECORD_SCHEMA)


def page_of(record_id):
    """The id in a record's name, as text; null for records of pages without id."""
    return F.when(F.startswith(record_id, F.lit("urn:page:")), F.url_decode(F.substring(record_id, 10, 1 << 30)))


def summary(archives: DataFrame, *, strict: bool = True) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record. A
    revisit's length is that of the response it names, found by a join on the records read."""
    records = stored(read_archives(archives, strict=strict, with_payload=False), "warc-records")
    lengths = (records.filter("record_type = 'response' and record_id is not null")
               .groupBy(F.col("record_id").alias("named")).agg(F.max("payload_bytes").alias("named_bytes")))
    lengths = lengths.join(records.filter("record_type = 'revisit'").select(F.col("refers_to").alias("named")).distinct(), "named", "left_semi")
    joined = records.join(stored(lengths, "warc-lengths"), records["refers_to"] == F.col("named"), "left")
    return joined.select(
        page_of(F.col("record_id")).alias("page_id"), F.coalesce("payload_bytes", "named_bytes").alias("payload_bytes"),
        "payload_digest", "record_type", page_of(F.col("refers_to")).alias("refers_to"))
