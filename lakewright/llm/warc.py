"""WARC in seekable Zstandard bundles.

Writing: each task turns its pages into WARC 1.1 records, groups them into independent Zstandard frames of
about `FRAME` bytes, and ends the bundle with a seek table (skippable frame 0x184D2A5E, footer magic
0x8F92EAB1), so that any frame can be read by itself. A manifest (Parquet) maps each record to its bundle,
frame and offset within the frame. A bundle is written under a name of its task attempt and only counts
through the manifest, so a repeated task leaves at most an unreferenced file.

Duplicates: of records with equal payloads of at least `REVISIT_FROM` bytes, the one with the largest
page_id is a response, the others are revisits of it without a payload; smaller payloads are always responses.
A block is an HTTP message (`application/http`): the status line, its headers, then the payload. Record ids are UUIDs
made from page_id and payload digest, so that a revisit can name its response; `X-Page-Id` keeps the number.

Reading: the bundles are dealt to tasks by bundle, as many tasks as the records' bytes ask for (`READ`); a task opens
each of its bundles once and reads frame by frame through the seek table. Single records: `read_record`.

Defined results: null html is an empty payload; a null page_id is written as an empty number, never chosen as the
response of a group and revisits its group's response; repeated rows of the chosen page_id are all responses (equal ones
with one record id); a null url is an empty target; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm import common

FRAME = 256 << 10
#: Bytes of records for each reading task, but for a bundle of more.
READ = 16 << 20
REVISIT_FROM = 1000
SALTS = 16
#: Fixed values of the seekable format and of WARC.
SKIPPABLE, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
VERSION = b"WARC/1.1"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"1970-01-01T00:00:00Z"

_INDEX = "page_id bigint, bundle string, frame bigint, frame_offset bigint, record_offset bigint, record_length bigint"
_READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def with_winner(pages: DataFrame) -> DataFrame:
    """page_id, url, html and `winner`: the page_id of the response of the row's group of duplicates, or null."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    large = rows.filter(F.octet_length("html") >= REVISIT_FROM)
    winners = large.groupBy("digest").agg(F.max("page_id").alias("winner"), F.count("*").alias("n")).filter("n > 1 and winner is not null")
    winners = common.cut(winners.select("digest", "winner"), "winners")
    if winners.count() <= common.BROADCAST_ROWS:
        joined = rows.join(F.broadcast(winners), "digest", "left")
    else:  # one payload may hold a third of all rows: its rows are dealt over salts
        salted = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"], "left")
    return joined.select("page_id", "url", "html", F.when(F.octet_length("html") >= REVISIT_FROM, F.col("winner")).alias("winner"))


def record_id(page_id: int | None, digest: str) -> bytes:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>".encode()


def _head(lines: list[bytes]) -> bytes:
    return b"\r\n".join([*lines, b"", b""])


def _number(n: int | None) -> bytes:
    return b"" if n is None else str(n).encode()


def record(page_id: int | None, url: str | None, payload: bytes, winner: int | None) -> bytes:
    """One record, with its payload or as a revisit."""
    digest = hashlib.sha1(payload).hexdigest()
    revisit = winner is not None and winner != page_id
    http = _head([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: " + str(len(payload)).encode()])
    block = http if revisit else http + payload
    lines = [
        VERSION,
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        b"WARC-Record-ID: " + record_id(page_id, digest),
        b"WARC-Date: " + DATE,
        b"WARC-Target-URI: " + (url or "").encode("utf-8", "replace").replace(b"\r", b"%0D").replace(b"\n", b"%0A"),
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"X-Page-Id: " + _number(page_id),
    ]
    if revisit:
        lines += [b"WARC-Profile: " + REVISIT_PROFILE, b"WARC-Refers-To: " + record_id(winner, digest), b"X-Refers-To-Page: " + _number(winner)]
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: " + str(len(block)).encode()]
    return _head(lines) + block + b"\r\n\r\n"


def _fields(raw: bytes, at: int) -> tuple[bytes, dict[str, str], int]:
    """(first line, fields by lower-case name, offset behind the empty line) of a head."""
    end = raw.index(b"\r\n\r\n", at)
    first, *lines = raw[at:end].split(b"\r\n")
    return first, {k.decode().lower(): v.decode("utf-8") for k, v in (x.split(b": ", 1) if b": " in x else (x.rstrip(b":"), b"") for x in lines)}, end + 4


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, offset behind the record) of the record at an offset; the payload's own length is `payload-length`."""
    first, headers, start = _fields(raw, at)
    if first != VERSION:
        raise ValueError("no WARC record at this offset")
    stop = start + int(headers["content-length"])
    if raw[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    _, http, body = _fields(raw, start)
    headers["payload-length"] = http["content-length"]
    return headers, raw[body:stop], stop + 4


class BundleWriter:
    """Frames and footer of one bundle."""

    def __init__(self, out) -> None:
        self.out, self.packer = out, zstandard.ZstdCompressor(level=3)
        self.at, self.frames, self.open, self.size = 0, [], [], 0

    def add(self, raw: bytes) -> tuple[int, int, int]:
        """(frame number, its place in the bundle, offset of the record in the frame's content)."""
        if self.size and self.size + len(raw) > FRAME:
            self.flush()
        place = len(self.frames), self.at, self.size
        self.open.append(raw)
        self.size += len(raw)
        return place

    def flush(self) -> None:
        if self.size:
            packed = self.packer.compress(b"".join(self.open))
            self.out.write(packed)
            self.frames.append((len(packed), self.size))
            self.at += len(packed)
            self.open, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """(place, packed length, content length) of each frame of a bundle (an open random-access file)."""
    size = source.size()
    source.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    source.seek(size - 9 - 8 * n)
    raw, out, at = source.read(8 * n), [], 0
    for packed, length in struct.iter_unpack("<II", raw):
        out.append((at, packed, length))
        at += packed
    return out


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """A folder that driver and executors share, by any scheme that Arrow reads."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def _uri(path: str) -> str:
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write bundles into folder; the manifest, as a table that was written and read again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        bundle = None
        for batch in batches:
            places = []
            for page, url, body, winner in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "html", "winner")], strict=True):
                if bundle is None:
                    bundle = BundleWriter(files.open_output_stream(f"{root}/{name}", compression=None))
                raw = record(page, url, body.encode("utf-8", "replace"), winner)
                places.append((*bundle.add(raw), len(raw)))
            columns = zip(*places, strict=True) if places else [()] * 4
            numbers = dict(zip(("frame", "frame_offset", "record_offset", "record_length"), [pa.array(x, pa.int64()) for x in columns], strict=True))
            yield common.batch_of(page_id=batch.column("page_id"), bundle=pa.array([name] * len(places), pa.string()), **numbers)
        if bundle is not None:
            bundle.close()

    return common.cut(with_winner(pages).mapInArrow(common.released(run), _INDEX), "manifest")


def read(manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Every record of the bundles in the manifest, read back from their frames: a row each."""
    schema = _READ + (", url string, payload binary" if payloads else "")
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in schema.split(", ")]
    size = manifest.agg(F.sum("record_length"), F.countDistinct("bundle")).first()
    tasks = max(1, min(size[1], -(-(size[0] or 0) // READ)))
    frames = manifest.groupBy("bundle", "frame_offset").agg(F.count("*").alias("n"))
    frames = frames.repartition(tasks, "bundle").sortWithinPartitions("bundle", "frame_offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        unpack = zstandard.ZstdDecompressor()
        wanted = (x for batch in batches for x in zip(*[batch.column(c).to_pylist() for c in ("bundle", "frame_offset", "n")], strict=True))
        for name, own in itertools.groupby(wanted, key=lambda x: x[0]):
            with files.open_input_file(f"{root}/{name}") as source:
                table = {at: (packed, length) for at, packed, length in seek_table(source)}
                for _, at, n in own:
                    packed, length = table[at]
                    source.seek(at)
                    content = unpack.decompress(source.read(packed), max_output_size=length)
                    rows, spot = [], 0
                    while spot < len(content):
                        headers, payload, spot = parse(content, spot)
                        rows.append(_row(headers, payload) + ((headers["warc-target-uri"], payload) if payloads else ()))
                    if len(rows) != n:
                        raise ValueError(f"{name}: {len(rows)} records in a frame, {n} in the manifest")
                    columns = zip(names, zip(*rows, strict=True), kinds, strict=False)
                    yield common.batch_of(**{c: pa.array(v, k) for c, v, k in columns})

    return frames.mapInArrow(common.released(run), schema)


def _row(headers: dict[str, str], payload: bytes) -> tuple:
    number = lambda x: int(x) if x else None
    kind, said, size = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:"), int(headers["payload-length"])
    if kind == "revisit":
        return number(headers["x-page-id"]), size, said, kind, number(headers["x-refers-to-page"])
    digest = hashlib.sha1(payload).hexdigest()
    if digest != said or len(payload) != size:
        raise ValueError("a payload differs from its digest")
    return number(headers["x-page-id"]), size, digest, kind, None


def read_record(folder: str, bundle: str, frame_offset: int, record_offset: int) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record: only its frame is read."""
    files, root = open_folder(folder)
    with files.open_input_file(f"{root}/{bundle}") as source:
        packed, length = next((p, n) for at, p, n in seek_table(source) if at == frame_offset)
        source.seek(frame_offset)
        content = zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=length)
    headers, payload, _ = parse(content, record_offset)
    return headers, payload


def query(pages: DataFrame) -> DataFrame:
    folder = _uri(common.new_path(pages.sparkSession, "warc"))
    return read(write(pages, folder), folder)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
w AS (SELECT h, max(page_id) AS winner FROM p WHERE octet_length(encode(h)) >= 1000 GROUP BY h)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
    CASE WHEN winner IS NULL OR winner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN winner <> page_id THEN winner END AS refers_to
FROM p LEFT JOIN w USING (h)"""
