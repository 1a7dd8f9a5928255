"""Token ids of documents in files of fixed-width bit packing.

Every id takes as many bits as the largest id of the vocabulary needs. 32 ids
fill exactly that many 32-bit words, so packing and unpacking are 32 shifts of
whole numpy columns. Ids lie in blocks of ``BLOCK_IDS`` ids; a table of block
offsets makes any range of ids one seek and one read.

A file, all numbers little-endian:

    blocks    ids of the documents one after the other, the last block padded by zeros
    footer    block offsets u64 (one more than blocks), checksum of each block u32,
              last id + 1 of each document u64, its doc_id i64, whether that is not null u8
    trailer   bits u32, ids in a block u32, ids u64, documents u64, start of the
              footer u64, crc32 of the footer u32, magic of 8 bytes

Documents are dealt into ranges of ``doc_id``, sorted, encoded and written by the
task that holds the range, which starts another file after ``FILE_IDS`` ids. Where
a file's first id stands among all ids follows from the sums over the files before.
A task that runs again writes files of other names; only those that the finished
task reports are read. Files go through ``pyarrow.fs`` into a folder that all
executors share.

Defined results: a null or empty text is its end token alone; a null id comes
first and stays null; rows of one id are written one by one, ordered by a hash of
their text; no documents give no files and no rows; other columns are ignored,
whatever their names. Texts are read whole, whatever their length.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.positions import PART, before, in_ranges
from skyledger.session import scratch_dir

from .common import partitions_for, small_batches, stored
from .packing import PieceIds

#: Ids in a block, a multiple of 32, and ids after which a task begins another file.
BLOCK_IDS, FILE_IDS = 4096, 16 << 20
#: Ids unpacked in one go when a whole file is read, and rows handed back together.
READ_IDS, READ_ROWS = 1 << 20, 8192
#: Bytes of text in one range of documents, on average.
RANGE_BYTES = 128 << 20
#: Words whose ids a worker remembers before it starts afresh.
REMEMBERED = 500_000
TRAILER = struct.Struct("<IIQQQI8s")
MAGIC = b"BITIDS01"

MANIFEST = "part int, file int, path string, ids long, docs long, bytes long"
#: Normaliser and pre-tokenizer of files whose ids never span white space.
NORMALIZER_APART = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
SPLIT_APART = {
    "type": "Split",
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids``, a multiple of 32 of them, in ``bits`` bits each."""
    lanes = ids.astype(np.uint64).reshape(-1, 32)
    words = np.zeros((len(lanes), bits), np.uint64)
    for lane in range(32):
        word, shift = divmod(lane * bits, 32)
        moved = lanes[:, lane] << np.uint64(shift)
        words[:, word] |= moved
        if shift + bits > 32:
            words[:, word + 1] |= moved >> np.uint64(32)
    return words.astype("<u4").tobytes()


def unpack(data: bytes, bits: int) -> np.ndarray:
    """The ids that ``pack`` was given, as little-endian unsigned 32-bit numbers."""
    words = np.frombuffer(data, "<u4").reshape(-1, bits).astype(np.uint64)
    mask = np.uint64((1 << bits) - 1)
    ids = np.empty((len(words), 32), "<u4")
    for lane in range(32):
        word, shift = divmod(lane * bits, 32)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 32:
            value = value | words[:, word + 1] << np.uint64(32 - shift)
        ids[:, lane] = value & mask
    return ids.reshape(-1)


class FileWriter:
    """Collects the bytes of one file."""

    def __init__(self, bits: int) -> None:
        self.bits, self.blocks, self.open = bits, [], []
        self.held = self.ids = 0
        self.ends: list[int] = []
        self.doc_ids: list[int | None] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"id {ids.max()} does not fit {self.bits} bits")
        self.open.append(ids)
        self.held += len(ids)
        self.ids += len(ids)
        self.ends.append(self.ids)
        self.doc_ids.append(doc_id)
        if self.held >= 16 * BLOCK_IDS:
            self._close_blocks(self.held // BLOCK_IDS)

    def _close_blocks(self, blocks: int) -> None:
        ids = np.concatenate(self.open) if self.open else np.zeros(0, "<u4")
        full, rest = ids[: blocks * BLOCK_IDS], ids[blocks * BLOCK_IDS :]
        size = BLOCK_IDS * self.bits // 8
        data = pack(full, self.bits)
        self.blocks += [data[k : k + size] for k in range(0, len(data), size)]
        self.open, self.held = [rest], len(rest)

    def data(self) -> bytes:
        """The whole file."""
        if padding := -self.held % BLOCK_IDS:
            self.open.append(np.zeros(padding, "<u4"))
            self.held += padding
        self._close_blocks(self.held // BLOCK_IDS)
        offsets = np.cumsum([0, *map(len, self.blocks)]).astype("<u8")
        sums = np.array([zlib.crc32(b) for b in self.blocks], "<u4")
        doc_ids = np.array([d or 0 for d in self.doc_ids], "<i8")
        known = np.array([d is not None for d in self.doc_ids], "u1")
        footer = b"".join(a.tobytes() for a in (offsets, sums, np.array(self.ends, "<u8"), doc_ids, known))
        trailer = TRAILER.pack(
            self.bits, BLOCK_IDS, self.ids, len(self.ends), int(offsets[-1]), zlib.crc32(footer), MAGIC
        )
        return b"".join([*self.blocks, footer, trailer])


class IdFile:
    """Random access to a file: any range of ids, any document."""

    def __init__(self, file) -> None:
        self.file = file
        size = file.size()
        if size < TRAILER.size:
            raise ValueError("no file of packed ids")
        trailer = TRAILER.unpack(self._read(size - TRAILER.size, TRAILER.size))
        self.bits, self.block_ids, self.n_ids, self.n_docs, start, checksum, magic = trailer
        if magic != MAGIC:
            raise ValueError("no file of packed ids")
        footer = self._read(start, size - TRAILER.size - start)
        if zlib.crc32(footer) != checksum:
            raise ValueError("the footer is damaged")
        blocks = -(-self.n_ids // self.block_ids)
        at, columns = 0, []
        for dtype, n in (("<u8", blocks + 1), ("<u4", blocks), ("<u8", self.n_docs), ("<i8", self.n_docs), ("u1", self.n_docs)):
            columns.append(np.frombuffer(footer, dtype, n, at))
            at += columns[-1].nbytes
        self.offsets, self.sums, self.ends, self.doc_ids, self.known = columns

    def _read(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        return self.file.read(length)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file; reads the blocks that hold them, in one go."""
        stop = min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, "<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids + 1
        base = int(self.offsets[first])
        data = memoryview(self._read(base, int(self.offsets[last]) - base))
        for k in range(first, last):
            if zlib.crc32(data[int(self.offsets[k]) - base : int(self.offsets[k + 1]) - base]) != self.sums[k]:
                raise ValueError(f"block {k} is damaged")
        return unpack(data, self.bits)[start - first * self.block_ids : stop - first * self.block_ids]

    def bounds(self, doc: int) -> tuple[int, int]:
        return (int(self.ends[doc - 1]) if doc else 0), int(self.ends[doc])

    def document(self, doc: int) -> np.ndarray:
        """Ids of the document at place ``doc`` of the file, its end token included."""
        return self.ids(*self.bounds(doc))

    def documents(self) -> Iterator[tuple[int | None, int, int, int, list[np.ndarray]]]:
        """``(doc_id, start, stop, crc32, ids)`` of all documents; ids in parts, read ``READ_IDS`` at a time."""
        start, held, base = 0, np.zeros(0, "<u4"), 0
        for doc_id, known, stop in zip(self.doc_ids.tolist(), self.known.tolist(), self.ends.tolist(), strict=True):
            parts, checksum, at = [], 0, start
            while at < stop:
                if at >= base + len(held):
                    base, held = at, self.ids(at, at + READ_IDS)
                part = held[at - base : stop - base]
                checksum = zlib.crc32(part, checksum)
                parts.append(part)
                at += len(part)
            yield (doc_id if known else None), start, stop, checksum, parts
            start = stop


class Encoder(dict):
    """Ids of texts; where a tokenizer's ids never span white space, of words, each encoded once.

    Words of characters up to U+017F are their own normal form, so they are lowered and cut
    here and only their pieces go to the tokenizer's model; other words go through all of it.
    """

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        shape = json.loads(self.tokenizer.to_str())
        splits = (shape.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.apart = shape.get("normalizer") == NORMALIZER_APART and splits[0] == SPLIT_APART
        self.cut = regex.compile(SPLIT_APART["pattern"]["Regex"]).findall
        model = self.tokenizer.model
        model._resize_cache(0)  # its own memory of words costs more than it saves
        self.pieces = PieceIds(model)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.is_special = regex.compile("|".join([r"[^\x00-\u017F]", "\u0130", *map(regex.escape, specials)])).search

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        if self.is_special(word):
            ids = self._encoded(word)
        else:
            ids = b"".join(map(self.pieces.__getitem__, self.cut(word.lower())))
        self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        # Python splits at these four, the tokenizer does not.
        if not self.apart or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return self._encoded(text)
        return b"".join(map(self.__getitem__, text.split()))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker and tokenizer; tasks that follow find the words of those before."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def bits_for(path: str, end_id: int) -> int:
    """Bits that the largest id takes."""
    from tokenizers import Tokenizer

    largest = max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0)
    return max(largest, end_id, 1).bit_length()


def write(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Write all documents below ``folder``; one row per file, with the place ``start`` of its first id.

    ``tokenizer`` is the path of a tokenizer file that every executor has.
    """
    spark = small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranged = in_ranges(
        rows.withColumn("hash", F.xxhash64("text")),
        F.col("doc_id").asc_nulls_first(),
        F.col("hash"),
        partitions=partitions_for(spark, -(-size // RANGE_BYTES)),
    ).drop("hash")
    bits = bits_for(tokenizer, end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        known, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        writer, part, files = FileWriter(bits), None, 0

        def flush() -> pa.RecordBatch:
            path, data = f"{root}/{uuid.uuid4().hex}.ids", writer.data()
            with store.open_output_stream(path) as out:
                out.write(data)
            values = [part, files, path, writer.ids, len(writer.ends), len(data)]
            schema = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("path", pa.string()), ("ids", pa.int64()), ("docs", pa.int64()), ("bytes", pa.int64())])
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, text, number in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), batch[PART].to_pylist(), strict=True):
                part = number
                writer.add(doc_id, np.frombuffer(known.of(text) + end, "<u4"))
                if writer.ids >= FILE_IDS:
                    yield flush()
                    writer, files = FileWriter(bits), files + 1
        if writer.ends:
            yield flush()

    manifest = stored(ranged.mapInArrow(encode, MANIFEST), "packed-ids")
    parts = before(manifest.groupBy("part").agg(F.sum("ids").alias("n")), "part", "n").select("part", "__before")
    earlier = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("ids").over(earlier), F.lit(0))
    # One row per range of documents: as many as there are partitions.
    placed = manifest.withColumn("inside", inside).join(F.broadcast(parts), "part")
    return placed.select("path", "docs", "ids", "bytes", (F.col("__before") + F.col("inside")).alias("start"))


def read(manifest: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """All documents of the files: id, place of the first id, number of ids, their crc32, and the ids."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())]
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, first in zip(batch["path"].to_pylist(), batch["start"].to_pylist(), strict=True):
                rows, held = [], 0
                with store.open_input_file(path) as file:
                    for doc_id, start, stop, checksum, parts in IdFile(file).documents():
                        ids = b"".join(p.tobytes() for p in parts) if with_ids else None
                        rows.append((doc_id, first + start, stop - start, checksum, ids))
                        held += stop - start if with_ids else 0
                        if len(rows) >= READ_ROWS or held >= READ_IDS:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = manifest.select("path", "start")
    tasks = manifest.sparkSession.sparkContext.defaultParallelism * 2
    found = files.repartition(tasks).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    return found if with_ids else found.drop("ids")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the documents to a fresh folder of the shared scratch space and read their digests back."""
    folder = scratch_dir(docs.sparkSession, "ids")
    return read(write(docs, tokenizer, folder, end_id), folder, with_ids=False)
