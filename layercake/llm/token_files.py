"""Token-id files: independent zstandard frames, a seek table, checksums.

A file follows the public zstandard seekable format:

    data frame ... data frame, index frame, seek table

Every frame can be decompressed alone.  A data frame holds the ids of whole
consecutive documents as little-endian unsigned integers of ``width`` bytes,
closed as soon as it holds ``frame_ids`` ids.  The index frame holds one JSON
line (width, number of documents), then three little-endian int64 arrays:
doc_id, number of ids, number of the data frame.  The seek table is a
skippable frame with the compressed size, decompressed size and checksum
(low 32 bits of XXH64 of the content) of every frame; its last nine bytes
give the number of frames.  A reader seeks to the end, reads seek table and
index, and decompresses just the frames of the documents it wants.

``write`` deals the documents out by ranges of doc_id, one file a partition,
so files in order of their number hold ascending doc_ids.  A task writes under
a name of its own and reports it only when the file is complete; a retried or
speculative attempt writes another name, and the manifest names the file of
the attempt that succeeded.

Defined results: a null or empty text is its end id alone; very long texts
are one long frame; rows with equal doc_id are ordered by their texts' hashes;
rows with a null doc_id come first (``fetch`` cannot ask for them); an empty
table gives no file and an empty manifest; extra columns are not stored.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from layercake.llm import tokens
from layercake.llm.common import arrow_batches, materialize, run_dir

# Fixed values of the zstandard seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
CHECKSUMS = 0x80


class FrameWriter:
    """Frames and the seek table of one file; ``out`` needs write(bytes)."""

    def __init__(self, out, width: int, frame_ids: int = 1 << 16, level: int = 3):
        self.out, self.width, self.frame_ids = out, width, frame_ids
        self.packer = zstandard.ZstdCompressor(level=level)
        self.table: list[tuple[int, int, int]] = []
        self.open: list[np.ndarray] = []
        self.held = 0
        self.doc_ids: list[int] = []
        self.unnamed = 0  # documents without doc_id: they come first
        self.counts: list[int] = []
        self.frames: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.unnamed += doc_id is None
        self.doc_ids.append(doc_id or 0)
        self.counts.append(len(ids))
        self.frames.append(len(self.table))
        self.open.append(ids)
        self.held += len(ids)
        if self.held >= self.frame_ids:
            self._flush()

    def _flush(self) -> None:
        if self.open:
            self._frame(np.concatenate(self.open).astype(f"<u{self.width}").tobytes())
            self.open, self.held = [], 0

    def _frame(self, content: bytes) -> None:
        packed = self.packer.compress(content)
        self.out.write(packed)
        self.table.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> None:
        self._flush()
        head = json.dumps({"width": self.width, "docs": len(self.doc_ids), "unnamed": self.unnamed}).encode() + b"\n"
        self._frame(head + b"".join(np.array(x, "<i8").tobytes() for x in (self.doc_ids, self.counts, self.frames)))
        body = b"".join(struct.pack("<III", *row) for row in self.table)
        body += FOOTER.pack(len(self.table), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)


class FrameReader:
    """Random access to one file; ``source`` needs seek, read and size."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - FOOTER.size)
        frames, flags, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("not a seekable token file")
        source.seek(size - FOOTER.size - 12 * frames)
        self.table = np.frombuffer(source.read(12 * frames), "<u4").reshape(frames, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        head, _, arrays = self.content(frames - 1).partition(b"\n")
        meta = json.loads(head)
        self.width = meta["width"]
        self.doc_ids, self.counts, self.frames = np.frombuffer(arrays, "<i8").reshape(3, meta["docs"])
        self.unnamed = meta["unnamed"]

    def names(self) -> pa.Array:
        """The doc_id of every document, null for the first ``unnamed``."""
        return pa.array(self.doc_ids, pa.int64(), mask=np.arange(len(self.doc_ids)) < self.unnamed)

    def content(self, frame: int) -> bytes:
        packed, size, check = (int(x) for x in self.table[frame])
        self.source.seek(int(self.starts[frame]))
        content = zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=size)
        if len(content) != size or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check:
            raise ValueError(f"checksum of frame {frame} does not hold")
        return content

    def documents(self, rows: np.ndarray | None = None):
        """(row number in the index, ids) of the given index rows, or of all;
        each frame is decompressed once."""
        rows = np.arange(len(self.doc_ids)) if rows is None else np.sort(rows)
        first = np.concatenate([[0], np.cumsum(self.counts)])
        now, ids = -1, None
        for r in rows:
            if self.frames[r] != now:
                now = self.frames[r]
                ids = np.frombuffer(self.content(int(now)), f"<u{self.width}").astype(np.uint32)
                base = first[np.searchsorted(self.frames, now)]
            yield int(r), ids[first[r] - base:first[r + 1] - base]


def write(spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2,
          frame_ids: int = 1 << 16) -> DataFrame:
    """Write ``docs`` (doc_id, text) below ``folder`` (a URI that pyarrow can
    open and all executors share); returns the manifest: part, path, n_docs,
    n_ids, in the order of the documents."""
    arrow_batches(spark)
    schema = "part int, path string, n_docs long, n_ids long"

    def save(batches):
        encoder, writer, n_ids, n_docs = None, None, 0, 0
        part = TaskContext.get().partitionId()
        path = f"{folder.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}.tokens.zst"
        for b in batches:
            if encoder is None:
                encoder = tokens.load(tokenizer)
                store, name = _store(path)
                store.create_dir(name.rpartition("/")[0], recursive=True)
                out = store.open_output_stream(name, compression=None)
                width = 2 if max(encoder.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
                writer = FrameWriter(out, width, frame_ids)
            end = np.array([end_id], np.uint32)
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.concatenate([encoder.ids(text or ""), end])
                writer.add(doc_id, ids)
                n_ids += len(ids)
                n_docs += 1
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([path]), pa.array([n_docs], pa.int64()),
                 pa.array([n_ids], pa.int64())], ["part", "path", "n_docs", "n_ids"])

    # a doc_id that very many rows have, or null, is split by the texts' hashes
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text").asc()]
    dealt = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order, F.asc("text"))
    return materialize(dealt.mapInArrow(save, schema), spark, "token_manifest")


def _store(path: str):
    """File system and name within it of a URI or an absolute path."""
    return fs.FileSystem.from_uri(path if re.match(r"[a-z0-9]+:", path) else f"file://{path}")


def _open(path: str):
    store, name = _store(path)
    return store.open_input_file(name)


def read_index(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    A file's first id follows from the manifest, one row a file; the files
    themselves are read in parallel, a frame at a time."""
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    n = max(1, manifest.count())

    def load(batches):
        for b in batches:
            for path, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with _open(path) as source:
                    reader = FrameReader(source)
                    starts = before + np.concatenate([[0], np.cumsum(reader.counts)])[:-1].astype(np.int64)
                    checks = np.zeros(len(starts), np.int64)
                    for row, ids in reader.documents():
                        checks[row] = zlib.crc32(ids.astype("<u4").tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [reader.names(), pa.array(starts), pa.array(reader.counts), pa.array(checks)],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    return (files.select("path", "before").repartition(n)
            .mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def fetch(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """Ids of the documents in ``wanted`` (doc_id): doc_id, ids.  Only frames
    that hold one of them are decompressed."""
    def index(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                with _open(path) as source:
                    reader = FrameReader(source)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(reader.doc_ids)), pa.array(np.arange(len(reader.doc_ids))),
                         reader.names()], ["path", "row", "doc_id"])

    def load(batches):
        for b in batches:
            for path, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with _open(path) as source:
                    reader = FrameReader(source)
                    for row, ids in reader.documents(np.array(rows)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([int(reader.doc_ids[row])], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int64()))],
                            ["doc_id", "ids"])

    found = manifest.select("path").mapInArrow(index, "path string, row long, doc_id long")
    rows = (found.join(wanted.select("doc_id").distinct(), "doc_id").groupBy("path")
            .agg(F.collect_list("row").alias("rows")))
    return rows.select("path", "rows").mapInArrow(load, "doc_id long, ids array<long>")


def token_folder(spark: SparkSession) -> str:
    return run_dir(spark, "token_files")
