"""WARC archives in Zstandard: one frame for each record, the dictionary in front.

An archive starts with a skippable frame that holds the dictionary; each record is a
frame of its own, so that archives can be joined and records read singly. Payloads
seen before are stored as revisits. Archives are written by the executors to a folder
that all share; a manifest, committed by Spark, lists those of the attempts that
counted, so that a retried task leaves at most a file that nothing refers to.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, shared_dir, table

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A dictionary is trained on this much of an archive's first records, at most.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 4 << 20, 32 << 10
#: An archive of this many compressed bytes is closed and another one begun.
ARCHIVE_BYTES = 256 << 20
END = b"\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to, is_revisit: bool, payload_digest: str, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One whole WARC/1.1 record: response with its payload, or revisit without."""
    uri = re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "about:blank")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{payload_digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if is_revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + END + block + END


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for an archive, trained on its first records; their raw bytes if they are too few."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, one for each frame, in bounded memory."""
    import zstandard

    data = stream.read(8)
    if len(data) < 8:
        raise ValueError("archive is cut off in its first frame")
    magic, size = struct.unpack("<II", data)
    raw = b""
    if magic == DICTIONARY_MAGIC:
        raw = stream.read(size)
        if len(raw) != size:
            raise ValueError("archive is cut off in its dictionary")
        data = b""
    elif data[:4] != FRAME_MAGIC:
        raise ValueError(f"archive starts with {magic:#x}, neither a dictionary nor a record")
    if raw[:4] == FRAME_MAGIC:  # the dictionary itself may be compressed
        raw = zstandard.ZstdDecompressor().decompress(raw)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw)) if raw else zstandard.ZstdDecompressor()
    data = data or stream.read(chunk)
    while data:
        if len(data) < 18:  # a frame's header may need as much
            data += stream.read(chunk)
        promised = zstandard.frame_content_size(data)
        one, parts = reader.decompressobj(), []
        while True:
            parts.append(one.decompress(data))
            if one.eof:
                data = one.unused_data or stream.read(chunk)
                break
            data = stream.read(chunk)
            if not data:
                raise ValueError("archive is cut off in a record")
        out = b"".join(parts)
        if promised not in (-1, len(out)):
            raise ValueError(f"frame holds {len(out)} bytes, its header says {promised}")
        yield out


def _checked(algorithm: str, value: str, data: bytes, what: str) -> None:
    """Compare a digest header with its data, if the algorithm is one that is known here."""
    if algorithm not in ("sha1", "sha256", "md5"):
        return
    raw = hashlib.new(algorithm, data).digest()
    if value.upper() != base64.b32encode(raw).decode() and value.lower() != raw.hex():
        raise ValueError(f"{what} differs from its digest")


def parse(data: bytes) -> dict:
    """A record's fields, after its headers, lengths and digests have been checked.

    Any type of record is read (warcinfo, request, resource and so on); digests are
    optional. The payload is the block without its HTTP headers where the record has
    such, else the whole block; a revisit has none. payload_digest is the header's, or
    made of the payload; page_id and refers_to are null unless they name a page of ours.
    """
    head, found, rest = data.partition(END)
    if not found:
        raise ValueError("record without an end of its headers")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    field: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and field:  # the header before goes on
            field[last] += " " + line.strip()  # noqa: F821
            continue
        last = name.lower()
        if not colon or not name or (last in field and last != "warc-concurrent-to"):
            raise ValueError(f"bad or repeated header: {line!r}")
        field[last] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in field:
            raise ValueError(f"record without {name}")
    if not field["content-length"].isdecimal():
        raise ValueError(f"bad length {field['content-length']!r}")
    size = int(field["content-length"])
    if len(rest) != size + 4 or rest[size:] != END:
        raise ValueError(f"block of {len(rest) - 4} bytes, its header says {size}")
    kind, block = field["warc-type"], rest[:size]
    payload, n = block, size
    if field.get("content-type", "").lower().startswith("application/http"):
        http, found, payload = block.partition(END)
        if not found:
            raise ValueError("block without the end of its HTTP headers")
        length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        n = int(length[1]) if length else len(payload)
        if kind == "response" and len(payload) != n and "warc-truncated" not in field:
            raise ValueError(f"payload of {len(payload)} bytes, its header says {n}")
    if kind == "revisit" and payload:
        raise ValueError("revisit with a payload")
    if "warc-block-digest" in field:
        _checked(*field["warc-block-digest"].split(":", 1), block, "block")
    given = field.get("warc-payload-digest")
    if given and kind != "revisit" and "warc-truncated" not in field:
        _checked(*given.split(":", 1), payload, "payload")
    page = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", field.get(name, ""))) else None
    return {
        "page_id": page("warc-record-id"), "url": field.get("warc-target-uri"), "payload": payload, "payload_bytes": n,
        "payload_digest": given.removeprefix("sha1:") if given else digest(payload), "record_type": kind, "refers_to": page("warc-refers-to"), "record_id": field["warc-record-id"],
    }


def write(pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write all rows as archives below folder; returns the manifest (path, records, bytes).

    Of equal payloads of at least min_bytes the row with the largest id is the response
    and the others revisit it. A null payload is empty; null ids rank below all others;
    if rows repeat the largest id, each of them is a response; an empty table gives an
    empty manifest; other columns are ignored.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    # digests that repeat, written first: as few as they mostly are, they are sent to the rows, which then stay where they are
    twice = materialise(rows.groupBy("sha").agg(F.max("id").alias("top"), F.count("*").alias("n")).filter("n > 1").select("sha", "top"), "repeated")
    rows = rows.join(twice, "sha", "left").withColumn("revisit", (F.octet_length("payload") >= min_bytes) & F.coalesce(~F.col("id").eqNullSafe(F.col("top")) & F.col("top").isNotNull(), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        records = (
            record(i, u, p, t, v, base64.b32encode(s).decode())
            for b in batches
            for i, u, p, s, t, v in zip(*(b.column(n).to_pylist() for n in ("id", "url", "payload", "sha", "top", "revisit")))
        )
        held = next(records, None)
        k = 0
        while held is not None:
            samples, size = [], 0
            while held is not None and len(samples) < SAMPLE_RECORDS and size < SAMPLE_BYTES:
                samples.append(held)
                size += len(held)
                held = next(records, None)
            raw = dictionary(samples)
            pack = zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
            name = f"{base}/part-{TaskContext.get().partitionId():05d}-{k:03d}-{uuid.uuid4().hex}.warc.zst"
            n = written = 0
            with store.open_output_stream(name, compression=None) as out:
                out.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
                waiting = iter(samples)
                while True:
                    data = next(waiting, None)
                    if data is None:
                        if held is None or written > ARCHIVE_BYTES:
                            break
                        data, held = held, next(records, None)
                    frame = pack.compress(data)
                    out.write(frame)
                    n += 1
                    written += len(frame)
            k += 1
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([written], pa.int64())], ["path", "records", "bytes"])

    return materialise(rows.select("id", "url", "payload", "sha", "top", "revisit").mapInArrow(run, "path string, records long, bytes long"), "manifest")


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest of all archives below a folder, of whatever origin; how many records they hold isn't known."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.lit(None).cast("long").alias("records"), F.col("length").alias("bytes"))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """All records of the archives that a manifest lists, each frame, header, length and
    digest checked: page_id, url, payload, payload_bytes, payload_digest, record_type,
    refers_to and record_id. An archive that is broken, or holds another number of records
    than its manifest says, is an error. An empty manifest gives no rows."""
    spark = manifest.sparkSession
    bounded_batches(spark)
    n = max(1, min(2048, manifest.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string())])
        for b in batches:
            for path, promised in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out, size, n = [], 0, 0
                with store.open_input_stream(path, compression=None) as stream:
                    for data in frames(stream):
                        r = parse(data)
                        out.append(r)
                        size, n = size + len(data), n + 1
                        if len(out) == 512 or size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out, size = [], 0
                if promised is not None and n != promised:
                    raise ValueError(f"{path} holds {n} records, not {promised}")
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    spread = manifest.select("path", "records").repartition(n, "path")
    return spread.mapInArrow(run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    back = read(write(table(spark, sf_dir, "pages"), folder), folder)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
