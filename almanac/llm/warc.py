"""WARC archives in Zstandard: written with a shared dictionary, read back frame by frame and validated.

An archive with any payload begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself compressed if that is
smaller; then each record is one frame with size and checksum. The reader loads the dictionary, decodes one frame per
record and checks version, mandatory fields, lengths of record, block and payload, both digests, and that the archive has
as many records as its manifest says. Archives are written by the tasks that hold the pages, below the shared folder and
under names of their own attempt; only the attempts whose rows arrive in the stored manifest count, so a task that is run again
leaves nothing that is read.

A dictionary is trained on the first SAMPLE_OF bytes of each payload, SAMPLE_BYTES in all; payloads themselves are whole.

Of pages with equal payloads of at least REVISIT_BYTES, the one with the largest page_id is the response and the others
are revisits of it, without payload. Groups are aggregated before the shuffle and only those of two or more are joined
back, by broadcast while they are at most SMALL_GROUPS, else by a shuffled join that AQE splits.

Defined cases: a null html is an empty payload; a null url gives a record without target; a null page_id is kept, revisits
the group's largest page_id, and is a response if that is null too; repeated rows of the largest page_id are all
responses; an empty table gives an empty manifest and no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm import tables

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES, SAMPLE_OF = 1 << 20, 8192
SMALL_GROUPS = 200_000
READ_BYTES = 64 << 10
DATE = "2000-01-01T00:00:00Z"
_SKIPPABLE, _FRAME, _TRAINED = 0x184D2A5D, b"\x28\xb5\x2f\xfd", b"\x37\xa4\x30\xec"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-block-digest", "warc-payload-digest")
MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


class Damaged(ValueError):
    """An archive that is not what its headers say."""


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(urn: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d*)>", urn)
    if not m:
        raise Damaged(f"unknown record id {urn!r}")
    return int(m[1]) if m[1] else None


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url)


def _url(uri: str) -> str:
    return re.sub(r"%([0-7][0-9A-F])", lambda m: chr(int(m[1], 16)), uri)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, size: int) -> bytes:
    """One record; size and digest are those of the whole payload, which a revisit leaves out."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary from samples: trained, or, where they are too few for that, a piece of them; empty without any."""
    samples, total = [], 0
    for p in payloads:
        if p:
            samples.append(p[:SAMPLE_OF])
            total += len(samples[-1])
        if total >= SAMPLE_BYTES:
            break
    size = min(DICTIONARY_BYTES, total // 10)
    if len(samples) >= 16 and size >= 2048:
        try:
            return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
        except zstandard.ZstdError:  # samples too much alike
            pass
    plain = b"".join(samples)[:4096]
    return b"" if plain[:4] in (_FRAME, _TRAINED) else plain


def _dictionary_frame(data: bytes) -> bytes:
    if not data:
        return b""
    packed = zstandard.ZstdCompressor(level=9).compress(data)
    body = packed if len(packed) < len(data) else data
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


class Writer:
    """Archives of one task: a new one after ARCHIVE_BYTES of records."""

    def __init__(self, folder: str):
        self.files, self.folder = fs.FileSystem.from_uri(folder)
        self.scheme = folder[: len(folder) - len(self.folder)] if folder.endswith(self.folder) else ""
        self.task, self.made, self.out = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}", 0, None

    def start(self, data: bytes) -> None:
        self.files.create_dir(self.folder, recursive=True)
        self.path = f"{self.folder}/{self.task}-{self.made:04d}.warc.zst"
        self.made += 1
        self.out = self.files.open_output_stream(self.path, compression=None)
        frame = _dictionary_frame(data)
        self.out.write(frame)
        self.compress = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(data) if data else None, write_checksum=True).compress
        self.records, self.written, self.raw = 0, len(frame), 0

    def add(self, rec: bytes) -> None:
        frame = self.compress(rec)
        self.out.write(frame)
        self.records, self.written, self.raw = self.records + 1, self.written + len(frame), self.raw + len(rec)

    def close(self) -> pa.RecordBatch:
        self.out.close()
        self.out = None
        return pa.RecordBatch.from_pydict({"path": [self.scheme + self.path], "n_records": [self.records], "n_bytes": [self.written]})


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Writer(folder)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                rows = batch.slice(a, 256).to_pydict()
                payloads = [(p or "").encode() for p in rows["payload"]]
                for i, payload in enumerate(payloads):
                    if w.out is None:
                        w.start(dictionary(payloads[i:]))
                    w.add(record(rows["page_id"][i], rows["url"][i], payload, rows["digest"][i], rows["kind"][i], rows["refers_to"][i], rows["size"][i]))
                    if w.raw >= ARCHIVE_BYTES:
                        yield w.close()
        if w.out is not None:
            yield w.close()

    return run


def frames(stream) -> Iterator[bytes]:
    """The contents of an archive's frames. A dictionary may lead; a frame must end where its record does."""
    head = stream.read(8)
    context = zstandard.ZstdDecompressor()
    rest = head
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == _SKIPPABLE:
        size = struct.unpack("<I", head[4:])[0]
        data = stream.read(size)
        if len(data) != size:
            raise Damaged("the dictionary is cut off")
        if data[:4] == _FRAME:
            data = zstandard.ZstdDecompressor().decompress(data)
        context = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
        rest = b""
    while True:
        rest = rest or stream.read(READ_BYTES)
        if not rest:
            return
        one, out = context.decompressobj(), []
        while not one.eof:
            if not rest:
                rest = stream.read(READ_BYTES)
                if not rest:
                    raise Damaged("a frame is cut off")
            try:
                out.append(one.decompress(rest))
            except zstandard.ZstdError as e:
                raise Damaged(f"not a frame: {e}") from None
            rest = one.unused_data
        yield b"".join(out)


def _fields(lines: list[str]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise Damaged(f"not a header line: {line!r}")
        out[name.lower()] = value.strip()
    return out


def parse(rec: bytes) -> dict:
    """A record's fields, validated; payload is None for a revisit."""
    head, gap, body = rec.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise Damaged("no WARC header")
    f = _fields(lines[1:])
    if missing := [x for x in _NEEDED if x not in f]:
        raise Damaged(f"missing fields: {missing}")
    if not f["content-length"].isdigit() or len(body) != int(f["content-length"]) + 4 or body[-4:] != b"\r\n\r\n":
        raise Damaged("the record's length is not its Content-Length")
    block = body[:-4]
    if f["warc-block-digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise Damaged("the block's digest differs")
    http, gap, payload = block.partition(b"\r\n\r\n")
    status, *rows = http.decode().split("\r\n")
    h = _fields(rows)
    if not gap or not status.startswith("HTTP/") or not h.get("content-length", "").isdigit():
        raise Damaged("no HTTP header in the block")
    kind, digest = f["warc-type"], f["warc-payload-digest"].removeprefix("sha1:")
    if kind not in ("response", "revisit"):
        raise Damaged(f"unknown type {kind!r}")
    if kind == "response" and (len(payload) != int(h["content-length"]) or hashlib.sha1(payload).hexdigest() != digest):
        raise Damaged("the payload's length or digest differs")
    if kind == "revisit" and (payload or "warc-refers-to" not in f):
        raise Damaged("a revisit has a payload, or refers to nothing")
    return {
        "page_id": _page_id(f["warc-record-id"]), "url": _url(f["warc-target-uri"]) if "warc-target-uri" in f else None, "payload_bytes": int(h["content-length"]), "payload_digest": digest,
        "record_type": kind, "refers_to": _page_id(f["warc-refers-to"]) if kind == "revisit" else None, "payload": payload if kind == "response" else None,
    }


def _read(payloads: bool):
    names = [c.split()[0] for c in RECORDS.split(", ")] + ["payload"] * payloads
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                files, local = fs.FileSystem.from_uri(path)
                rows, done, held = [], 0, 0
                with files.open_input_stream(local, compression=None) as stream:
                    for rec in frames(stream):
                        rows.append(parse(rec))
                        held += len(rec)
                        if len(rows) == 1024 or held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in zip(names, kinds)], names)
                            done, rows, held = done + len(rows), [], 0
                if done + len(rows) != n:
                    raise Damaged(f"{path} has {done + len(rows)} records; its manifest says {n}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in zip(names, kinds)], names)

    return run


def plan(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with digest, size, kind and refers_to of each record."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns({"digest": F.sha1(F.encode("payload", "UTF-8")), "size": F.octet_length("payload").cast("long")})
    equal = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size").agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
    equal = tables.stored(equal.where("n > 1").select(F.col("digest").alias("_d"), F.col("size").alias("_s"), "kept"), "warc-groups")
    rows = rows.join(tables.small(equal, SMALL_GROUPS), (F.col("digest") == F.col("_d")) & (F.col("size") == F.col("_s")), "left")
    again = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return rows.select("page_id", "url", "payload", "digest", "size", F.when(again, "revisit").otherwise("response").alias("kind"), F.when(again, F.col("kept")).alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes archives of pages (page_id, url, html) below folder and returns the stored manifest: path, n_records, n_bytes."""
    folder = folder or tables.new_folder(pages.sparkSession, "warc")
    try:
        fs.FileSystem.from_uri(folder)
    except (pa.ArrowException, OSError) as e:
        raise ValueError(f"archives are written through pyarrow.fs, which cannot open {folder}; give a folder in a store that it knows") from e
    return tables.stored(plan(pages).mapInArrow(_write(folder), MANIFEST), "warc-manifest")


def read(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of a manifest's archives, each archive streamed by one task; raises Damaged where one is not valid."""
    n = max(1, min(manifest.count(), 10_000))
    schema = RECORDS + ", payload binary" * payloads
    return manifest.select("path", "n_records").repartition(n, "path").mapInArrow(_read(payloads), schema)
