"""Token ids in files of independent zstandard frames with a trailing seek table.

A file is a sequence of ordinary zstandard frames, then two skippable frames that every
zstandard decoder passes over:

* frames: the little-endian 32-bit ids of whole documents, one after another, about
  ``FRAME_IDS`` ids in each (one document's ids are never cut);
* document index (skippable, magic 0x184D2A50): a zstandard frame of 17 bytes a document --
  a byte that is 1 if the doc_id is null, then doc_id, number of ids (both 64-bit) -- in
  blocks of at most ``INDEX_DOCS``, each preceded by its own 32-bit compressed length,
  number of the first frame, and XXH64 checksum of the block;
* seek table (skippable, magic 0x184D2A5E): for each frame its compressed and decompressed
  length and the low 32 bits of the XXH64 of its decompressed bytes, then the number of
  frames, a descriptor byte (checksums on) and the seekable format's magic number.

A reader opens the end of the file, finds the frames of the documents it wants, reads and
decompresses those alone and compares their checksums.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import folder, input_table, materialize, open_folder, slices, spread_name, table
from touchline.llm.packing import default_vocabulary
from touchline.llm.tokens import WordEncoder

END_ID = 1
FRAME_IDS = 1 << 16
INDEX_DOCS = 1 << 14
LEVEL = 1
# Fixed values of the zstandard format and its seekable extension.
SKIPPABLE_SEEK = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80

INDEX_ENTRY = np.dtype([("null", "u1"), ("doc_id", "<i8"), ("n", "<i8")])


class DamagedFile(ValueError):
    """A checksum or a structure of a token file is not as written."""


class TokenFileWriter:
    """Writes documents one after another; the memory it needs is that of a frame and of the tables."""

    def __init__(self, out, level: int = LEVEL, frame_ids: int = FRAME_IDS):
        import xxhash
        import zstandard

        self.out, self.frame_ids, self.digest = out, frame_ids, xxhash.xxh64_intdigest
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.waiting: list[bytes] = []
        self.held = 0
        self.seek: list[tuple[int, int, int]] = []
        self.index: list[bytes] = []
        self.docs: list[tuple[int, int, int]] = []
        self.first_frame = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Appends one document's little-endian 32-bit ids."""
        if len(self.docs) >= INDEX_DOCS:
            self._frame()
            self._block()
        elif self.held and self.held + len(ids) > 4 * self.frame_ids:
            self._frame()
        self.docs.append((doc_id is None, doc_id or 0, len(ids) // 4))
        self.waiting.append(ids)
        self.held += len(ids)

    def _frame(self) -> None:
        if not self.waiting:
            return
        raw = b"".join(self.waiting)
        self.waiting, self.held = [], 0
        if raw:
            packed = self.compressor.compress(raw)
            self.out.write(packed)
            self.seek.append((len(packed), len(raw), self.digest(raw) & 0xFFFFFFFF))

    def _block(self) -> None:
        raw = np.array(self.docs, dtype=INDEX_ENTRY).tobytes()
        packed = self.compressor.compress(raw)
        self.index.append(struct.pack("<IIQ", len(packed), self.first_frame, self.digest(raw)) + packed)
        self.docs, self.first_frame = [], len(self.seek)

    def finish(self) -> None:
        self._frame()
        if self.docs:
            self._block()
        index = b"".join(self.index)
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        seek = b"".join(struct.pack("<III", *x) for x in self.seek)
        tail = struct.pack("<IBI", len(self.seek), CHECKSUMS, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(seek) + len(tail)) + seek + tail)


class TokenFileReader:
    """Reads all documents in order, or only those asked for."""

    def __init__(self, source):
        import xxhash
        import zstandard

        self.source, self.digest = source, xxhash.xxh64_intdigest
        self.decompressor = zstandard.ZstdDecompressor()
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUMS:
            raise DamagedFile("no seek table")
        table_at = size - 9 - 12 * n - 8
        kind, length = struct.unpack("<II", self._at(table_at, 8))
        if kind != SKIPPABLE_SEEK or length != 12 * n + 9:
            raise DamagedFile("no seek table")
        self.frames = np.frombuffer(self._at(table_at + 8, 12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.frame_at = np.cumsum(self.frames[:, 0]) - self.frames[:, 0]
        self.index_at = int(self.frames[:, 0].sum())
        self.index_end = table_at

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def _frame(self, k: int) -> bytes:
        packed, size, check = self.frames[k].tolist()
        raw = self.decompressor.decompress(self._at(int(self.frame_at[k]), packed), max_output_size=size)
        if len(raw) != size or self.digest(raw) & 0xFFFFFFFF != check:
            raise DamagedFile(f"frame {k}")
        return raw

    def _blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        kind, length = struct.unpack("<II", self._at(self.index_at, 8))
        at, end = self.index_at + 8, self.index_at + 8 + length
        if kind != SKIPPABLE_INDEX or end != self.index_end:
            raise DamagedFile("no document index")
        while at < end:
            packed, first, check = struct.unpack("<IIQ", self._at(at, 16))
            raw = self.decompressor.decompress(self._at(at + 16, packed))
            if self.digest(raw) != check:
                raise DamagedFile("document index")
            yield first, np.frombuffer(raw, dtype=INDEX_ENTRY)
            at += 16 + packed

    def documents(self, wanted: set[int | None] | None = None) -> Iterator[tuple[int | None, bytes]]:
        """(doc_id, ids) in the order written; with wanted, only frames that hold such documents are read."""
        for first, docs in self._blocks():
            frame, at, held, raw = first, 0, -1, b""
            for null, doc_id, n in docs.tolist():
                if at and at == self.frames[frame, 1] and n:
                    frame, at = frame + 1, 0
                doc_id = None if null else doc_id
                if wanted is None or doc_id in wanted:
                    if held != frame and n:
                        held, raw = frame, self._frame(frame)
                    yield doc_id, raw[at : at + 4 * n] if n else b""
                at += 4 * n


def write_token_files(docs: DataFrame, out: str, vocabulary: str | None = None, end_id: int = END_ID,
                      frame_ids: int = FRAME_IDS) -> DataFrame:
    """Writes the ids of every text, then the end id, in ascending doc_id order (null first) to files below out.

    Returns the manifest, one row a file: part (files in this order hold ascending doc_ids),
    path, n_docs, n_ids, first_id (the ids in all files before it).  A task's file has a name
    of its own and counts only if the manifest names it, so a repeated attempt leaves no
    trace in the results.  Documents with one doc_id are ordered by a hash of their
    text and may lie in several files.  A null text is empty.
    """
    vocabulary = vocabulary or default_vocabulary()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, system, path, writer, n_docs, n_ids = TaskContext.get().partitionId(), None, "", None, 0, 0
        for batch in slices(batches, "text", 8 << 20):
            if writer is None:
                system, where = open_folder(out)
                path = f"{where}/{spread_name(f'part-{part:06d}', '.zst')}"
                sink = system.open_output_stream(path, compression=None)
                writer = TokenFileWriter(sink, frame_ids=frame_ids)
            ids, counts = WordEncoder.of(vocabulary).encode(batch.column("text"))
            ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            ends = 4 * np.cumsum(counts + 1)
            raw, begin = ids.tobytes(), 0
            for doc_id, end in zip(batch.column("doc_id").to_pylist(), ends.tolist()):
                writer.add(doc_id, raw[begin:end])
                begin = end
            n_docs, n_ids = n_docs + len(counts), n_ids + len(ids)
        if writer is not None:
            writer.finish()
            sink.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [path], "n_docs": [n_docs], "n_ids": [n_ids]})

    rows = input_table(docs, doc_id="long", text="string")
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    written = materialize(ordered.mapInArrow(write, "part long, path string, n_docs long, n_ids long"), "token-manifest")
    # One row a file.
    return written.withColumn("first_id", F.sum("n_ids").over(Window.orderBy("part")) - F.col("n_ids"))


def read_token_files(manifest: DataFrame, out: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian) of all documents."""
    return _read(manifest, out, "ids binary", lambda ids: ids)


def _read(manifest: DataFrame, out: str, column: str, value) -> DataFrame:
    name, kind = column.split()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(out)
        for row in (x for batch in batches for x in batch.to_pylist()):
            rows, start, held = [], row["first_id"], 0
            with system.open_input_file(row["path"]) as source:
                for doc_id, ids in TokenFileReader(source).documents():
                    rows.append((doc_id, start, len(ids) // 4, value(ids)))
                    start += len(ids) // 4
                    held += len(ids) if kind == "binary" else 64
                    if held > 8 << 20:
                        yield of(rows)
                        rows, held = [], 0
            if rows:
                yield of(rows)

    def of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary() if kind == "binary" else pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["doc_id", "start", "n_tokens", name])

    files = manifest.select("part", "path", "first_id")
    # Each file a task of its own.
    parts = files.sparkSession.sparkContext.defaultParallelism * 4
    return files.repartition(parts, "part").mapInArrow(read, f"doc_id long, start long, n_tokens long, {name} {kind}")


def op5_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents, reads the files back and returns what they hold, by its checksum."""
    import binascii

    out = folder(spark, "tokens")
    manifest = write_token_files(table(spark, sf_dir, "documents"), out)
    return _read(manifest, out, "ids_crc32 long", binascii.crc32)
