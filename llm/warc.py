"""WARC archives in Zstandard form: writer and reader.

Layout of an archive (the public .warc.zst convention): an optional skippable
frame (magic 0x184D2A5D) that holds the dictionary, itself possibly compressed,
then one Zstandard frame per record. Each task streams its rows into archives of
its own under the given folder and returns their manifest rows; only the manifest,
which Spark commits, says which archives count, so a task that is run again or
twice leaves at most files that nobody lists. Writer and reader hold one record
at a time (the writer also a bounded sample to train its dictionary).

The reader also takes archives that others wrote: WARC/1.0 and 1.1, every record type,
any record id, folded and repeated header lines, records with or without digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from kinship.session import shared_folder, write_table
from llm._spark import ship

# Fixed values of the formats.
SKIPPABLE_DICT = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"  # pages carry no time
ID_PREFIX = "urn:page:"

ARCHIVE_BYTES = 128 << 20  # a task starts a new archive beyond this size
DICT_BYTES = 16 << 10
DICT_SAMPLE_ROWS = 200
DICT_SAMPLE_BYTES = 2 << 20
READ_BYTES = 1 << 18

_RECORD = ("page_id long, record_type string, refers_to long, uri string, payload_digest string, payload_bytes long, "
           "record_id string, refers_to_id string")

# The digest algorithms that are checked, as labels name them, and the versions read.
ALGORITHMS = {"sha1": "sha1", "sha-1": "sha1", "sha256": "sha256", "sha-256": "sha256", "sha512": "sha512", "sha-512": "sha512", "md5": "md5"}
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme and host of its file system, as Hadoop's settings on the
    driver complete it: a folder without a scheme is on the default file system, wherever
    that is, and never on an executor's own disk unless that is the default."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path)
    return str(whole.toString())


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a qualified folder. A scheme that pyarrow does not know is an
    error; a path without any is a local file, which only ``read_archive`` may be given."""
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", uri):
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split(":", 1)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{scheme}://{rest.lstrip('/')}")


def encode_record(page_id, uri, payload: bytes, digest: str, response_id, is_response: bool) -> bytes:
    """One WARC record. A revisit has the HTTP head but no payload."""
    name = lambda x: f"<{ID_PREFIX}{'' if x is None else x}>"
    clean = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in uri or "")
    block = HTTP_HEAD + (payload if is_response else b"")
    fields = [("WARC-Type", "response" if is_response else "revisit"), ("WARC-Record-ID", name(page_id)), ("WARC-Date", DATE)]
    if uri is not None:
        fields.append(("WARC-Target-URI", clean))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if not is_response:
        fields += [("WARC-Refers-To", name(response_id)), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    """``fields``: lower-case name -> all its values in order; ``payload``: the block without its
    HTTP head, where it has one."""

    fields: dict[str, list[str]]
    block: bytes
    payload: bytes

    def get(self, name: str) -> str | None:
        return self.fields.get(name, [None])[0]


def _fields(lines: list[bytes], where: str) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    last = None
    for line in lines:
        text = line.decode("utf-8", "replace")
        if line[:1] in (b" ", b"\t") and last:  # a folded line goes on
            out[last][-1] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"{where}: bad header line {line!r}")
        last = name.strip().lower()
        out.setdefault(last, []).append(value.strip())
    return out


def _unchunked(body: bytes) -> bytes | None:
    """An HTTP body without its chunk lines, or None where they do not fit."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        size = re.match(rb"[0-9A-Fa-f]{1,15}", body[at:line]) if line >= 0 else None
        if not size:
            return None
        n = int(size.group(), 16)
        if not n:
            return b"".join(out)
        out.append(body[line + 2:line + 2 + n])
        at = line + 2 + n + 2


def _agrees(label: str | None, data: bytes) -> bool:
    """Whether a ``algorithm:value`` label fits the data; an unknown algorithm cannot be told."""
    name, _, value = (label or "").partition(":")
    algorithm = ALGORITHMS.get(name.strip().lower())
    if not algorithm:
        return True
    found, value = hashlib.new(algorithm, data).digest(), value.strip()
    return value.lower() == found.hex() or value.upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=")


def decode_record(raw: bytes, where: str) -> Record:
    """One record; raises ValueError where version, header lines, length or a digest of a
    known algorithm do not hold. A truncated record's payload digest is not checked, and that
    of a chunked body may be of the body with or without its chunk lines."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or lines[0].strip() not in VERSIONS:
        raise ValueError(f"{where}: no WARC header")
    fields = _fields(lines[1:], where)
    for k in NEEDED:
        if k not in fields:
            raise ValueError(f"{where}: {k} is missing")
    length = fields["content-length"][0]
    if not length.isdecimal():
        raise ValueError(f"{where}: bad length")
    n = int(length)
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"{where}: the record has {len(rest) - 4} bytes, its header says {n}")
    record = Record(fields, rest[:n], rest[:n])
    kind = record.get("warc-type").lower()
    http, sep, body = record.block.partition(b"\r\n\r\n")
    if kind in ("response", "request", "revisit") and sep and (record.get("content-type") or "application/http").lower().startswith("application/http"):
        record.payload = body
    if not _agrees(record.get("warc-block-digest"), record.block):
        raise ValueError(f"{where}: block and digest differ")
    if kind in ("response", "resource") and "warc-truncated" not in fields and not _agrees(record.get("warc-payload-digest"), record.payload):
        plain = _unchunked(record.payload) if b"chunked" in http.lower() else None
        if plain is None or not _agrees(record.get("warc-payload-digest"), plain):
            raise ValueError(f"{where}: payload and digest differ")
    return record


class _Archive:
    """An archive being written: dictionary frame, then a frame for each record."""

    def __init__(self, fs, path: str, dictionary: bytes | None):
        self.path, self.records, self.size = path, 0, 0
        self.out = fs.open_output_stream(path, compression=None)
        given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.squeeze = zstandard.ZstdCompressor(level=6, dict_data=given, write_content_size=True)
        if dictionary:
            stored = zstandard.ZstdCompressor(level=12).compress(dictionary)
            self._put(struct.pack("<II", SKIPPABLE_DICT, len(stored)) + stored)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.squeeze.compress(record))
        self.records += 1


def _train(samples: list[bytes]) -> bytes | None:
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little or too uniform text: the format also takes plain content
        return b"".join(samples)[-DICT_BYTES:] or None


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write ``(page_id, uri, payload, digest, response_id, is_response)`` rows as
    archives; returns the committed manifest ``(path, records, bytes)``. ``digest``: the SHA-1
    of the full payload, in hexadecimal or base32."""
    given, folder = folder, qualified(records.sparkSession, folder)
    # the manifest names a local file as the caller named its folder
    scheme = "" if given.startswith("/") and folder.startswith("file:") else folder.partition(":")[0] + "://"
    base32 = lambda d: base64.b32encode(bytes.fromhex(d)).decode() if len(d) == 40 else d

    def work(batches):
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        stem = f"{base}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        waiting: list[bytes] = []
        current, done, dictionary, trained, held = None, [], None, False, 0

        def flush():
            nonlocal current, dictionary, trained, held
            if not trained:
                dictionary, trained = _train(waiting), True
            for record in waiting:
                if current is None:
                    current = _Archive(fs, f"{stem}-{len(done):04d}.warc.zst", dictionary)
                current.add(record)
                if current.size >= ARCHIVE_BYTES:
                    current.out.close()
                    done.append(current)
                    current = None
            waiting.clear()
            held = 0

        for b in batches:
            for i in range(b.num_rows):
                row = [c[i].as_py() for c in b.columns]
                row[3] = base32(row[3])
                waiting.append(encode_record(*row))
                held += len(waiting[-1])
                if trained or len(waiting) >= DICT_SAMPLE_ROWS or held >= DICT_SAMPLE_BYTES:
                    flush()
        flush()
        if current is not None:
            current.out.close()
            done.append(current)
        yield pa.RecordBatch.from_arrays(
            [pa.array([scheme + a.path for a in done], pa.string()), pa.array([a.records for a in done], pa.int64()),
             pa.array([a.size for a in done], pa.int64())], ["path", "records", "bytes"])

    rows = records.select("page_id", "uri", "payload", "digest", "response_id", "is_response")
    return write_table(rows.mapInArrow(work, "path string, records long, bytes long"), "warc-manifest")


def read_archive(path: str):
    """Every ``Record`` of one archive, in order. Skippable frames between records are passed over."""
    fs, local = _filesystem(path)
    with fs.open_input_stream(local, compression=None) as stream:
        buffer = stream.read(8)
        dictionary = None
        if len(buffer) == 8 and struct.unpack("<I", buffer[:4])[0] == SKIPPABLE_DICT:
            n = struct.unpack("<I", buffer[4:])[0]
            stored = stream.read(n)
            if len(stored) != n:
                raise ValueError(f"{path}: the dictionary frame is cut off")
            if stored[:4] == ZSTD_MAGIC:
                stored = zstandard.ZstdDecompressor().decompress(stored)
            dictionary, buffer = zstandard.ZstdCompressionDict(stored), b""
        expand = zstandard.ZstdDecompressor(dict_data=dictionary)
        nth = 0
        while True:
            buffer = buffer or stream.read(READ_BYTES)
            if not buffer:
                return
            frame, parts = expand.decompressobj(), []
            while True:
                try:
                    parts.append(frame.decompress(buffer))
                except zstandard.ZstdError as e:
                    raise ValueError(f"{path}, frame {nth}: {e}") from e
                if frame.eof:
                    buffer = frame.unused_data
                    break
                buffer = stream.read(READ_BYTES)
                if not buffer:
                    raise ValueError(f"{path}, frame {nth}: cut off")
            raw = b"".join(parts)
            if raw:  # a skippable frame gives nothing
                yield decode_record(raw, f"{path}, frame {nth}")
            nth += 1


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """Read and validate every archive of a manifest ``(path, records)``: one row per record, for a
    revisit without ``payload_bytes``; with the payload itself if asked for. ``records`` may be
    null where it is not known. ``page_id`` and ``refers_to`` are the numbers that this writer
    gives; the ids of other writers stand in ``record_id`` and ``refers_to_id`` alone."""
    spark = manifest.sparkSession
    root = qualified(spark, "/").rstrip("/")

    def number(x: str | None):
        own = re.fullmatch(rf"<{ID_PREFIX}(-?[0-9]+)>", x or "")
        return int(own.group(1)) if own else None

    def rows(path, want):
        found = 0
        for record in read_archive(path):
            found += 1
            kind = record.get("warc-type").lower()
            revisit = kind == "revisit"
            digest = record.get("warc-payload-digest")
            yield (number(record.get("warc-record-id")), kind, number(record.get("warc-refers-to")) if revisit else None,
                   record.get("warc-target-uri"), digest and digest.removeprefix("sha1:"),
                   None if revisit else len(record.payload), record.get("warc-record-id"), record.get("warc-refers-to"),
                   record.payload if payloads and not revisit else None)[:9 if payloads else 8]
        if want is not None and found != want:
            raise ValueError(f"{path}: {found} records, the manifest says {want}")

    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("record_id", pa.string()),
                        ("refers_to_id", pa.string()), ("payload", pa.binary())])
    if not payloads:
        schema = schema.remove(8)

    def work(batches):
        for b in batches:
            for path, want in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part, size = [], 0
                for row in rows(path, want):
                    part.append(row)
                    size += 200 + len(row[8] or b"" if payloads else b"")
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*part), schema)], schema=schema)
                        part, size = [], 0
                if part:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*part), schema)], schema=schema)

    path = F.when(F.col("path").startswith("/"), F.concat(F.lit(root), "path")).otherwise(F.col("path"))
    paths = manifest.select(path.alias("path"), "records")
    tasks = max(1, manifest.count())  # one archive a task
    return paths.repartition(tasks).mapInArrow(work, _RECORD + (", payload binary" if payloads else ""))


def warc_round_trip(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", uri_col: str = "url",
                    payload_col: str = "html", min_revisit_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Write a record per row, then read the archives back.

    Returns ``(manifest, records)``; records: ``(page_id, record_type, refers_to, uri,
    payload_digest, payload_bytes)``. Of rows with equal payloads of at least
    ``min_revisit_bytes`` the one with the largest id is the response and the others
    revisit it; smaller payloads are all responses. A revisit's length is its
    response's, found by ``refers_to`` in the archives.

    A null payload is empty; a null uri writes no target line; a null id is smaller
    than all others, and rows with the id of a response are responses too (so are
    repeated rows). An empty table gives no archives and no records. Other columns
    are ignored.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    rows = pages.select(pages[id_col].cast("long").alias("_id"), pages[uri_col].cast("string").alias("_uri"),
                        F.coalesce(pages[payload_col].cast("string"), F.lit("")).cast("binary").alias("_payload"))
    rows = rows.withColumn("_sha", F.sha1("_payload"))
    # narrow, and written: the payloads then meet it in a join that splits a hot payload
    best = write_table(rows.groupBy("_sha").agg(F.max("_id").alias("_best")), "warc-responses")
    chosen = rows.join(best, "_sha").withColumn(
        "_first", F.col("_id").eqNullSafe(F.col("_best")) | (F.octet_length("_payload") < min_revisit_bytes))
    records = chosen.select(
        F.col("_id").alias("page_id"), F.col("_uri").alias("uri"), F.when(F.col("_first"), F.col("_payload")).alias("payload"),
        F.col("_sha").alias("digest"), F.col("_best").alias("response_id"), F.col("_first").alias("is_response"))
    manifest = write_archives(records, folder)
    back = read_archives(manifest).drop("record_id", "refers_to_id")
    response = (back.where("record_type = 'response'").groupBy(F.col("page_id").alias("_rid"))
                .agg(F.max("payload_bytes").alias("_n")))
    full = (back.join(response, F.col("refers_to") == F.col("_rid"), "left")
            .withColumn("payload_bytes", F.coalesce("payload_bytes", "_n")).drop("_rid", "_n"))
    return manifest, full
