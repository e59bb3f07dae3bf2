"""Token ids as shard files: zstandard frames over a shared dictionary, with an offset index.

File layout (little endian), one file per partition of the ascending doc_id order:

    magic b"VTOK1\\0\\0\\0" | SHA-256 of the dictionary (32 bytes) | n documents (u64)
    | index: n rows of (doc_id i64, is_null u8, n_tokens u64, offset u64), packed
    | frames: one zstandard frame per document over its ids as u32

A short document is read by its index row and one frame.  The folder also holds the
dictionary and a manifest (Parquet, written by Spark) that names the files of the
attempts that succeeded; files of lost or repeated attempts are in no manifest and
are never read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veriscope.llm.common import documents, write_table
from veriscope.session import scratch_path

MAGIC = b"VTOK1\0\0\0"
HEAD = "<8s32sQ"
HEAD_BYTES = struct.calcsize(HEAD)
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u8"), ("at", "<u8")])
#: Characters below this have a context-free normal form and a lower case below it.
PLAIN = 0x100
#: Entries that a worker remembers in each of two generations.
CHUNKS, PIECES = 50_000, 250_000


class Memory(dict):
    """Remembers ``make(key)``; a full generation becomes the old one, from which hits are taken over."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordEncoder:
    """Encodes texts with a tokenizers file, looking up repeated words in a bounded memory.

    The tokenizer cuts a text into pieces that never span white space, so the ids of a
    text are those of its pieces, one after the other.  Texts of plain Latin characters
    are cut by the tokenizer's own rule and each new piece is encoded by the library's
    model; other texts are cut at spaces and line ends only, and each new chunk is
    encoded by the library as a whole.
    """

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks = Memory(self._whole, CHUNKS)
        self.pieces = Memory(self._piece, PIECES)
        letters = "".join(c for c in map(chr, range(PLAIN)) if c.isalpha() and c == c.lower())
        digits = "".join(c for c in map(chr, range(PLAIN)) if c.isnumeric())
        self.split = re.compile(rf"[{letters}]+|[{digits}]|'(?:[stmd]|re|ve|ll)|[^\s{letters}{digits}]+")
        self.odd = re.compile(r"[^\t\n\r -~\xa1-\xff]")
        self.symbols = {ord(c): s for c in map(chr, range(33, PLAIN)) if not self.odd.search(c)
                        for s in [self._symbols(c.lower())] if s}
        self.fast = self._agrees()

    def _symbols(self, c: str) -> str:
        return "".join(p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c))

    def _agrees(self) -> bool:
        """Piece by piece must equal the library on a probe; another kind of tokenizer takes the slow way."""
        probe = ["Don't", "été's", "a1b22,c", "x''s", "...", "Ñandú!!", "%%ok&&", "'tis", "we'll'd", "ÀÉÎ9ß"]
        return all(self._piecewise(p) == self._whole(p) for p in probe)

    def _whole(self, chunk: str) -> bytes:
        return np.asarray(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece.translate(self.symbols))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piecewise(self, chunk: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split.findall(chunk.lower())))

    def ids(self, text: str) -> bytes:
        """The ids as little-endian u32 bytes."""
        if any(s in text for s in self.special):
            return self._whole(text)
        if self.fast and not self.odd.search(text):
            return self._piecewise(text)
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def spread_slices(ids: bytes, most: int = 4096, slices: int = 16) -> bytes:
    """At most ``most`` u32 ids of a document: all, or equal slices spread from its start to its end."""
    n, width = len(ids) // 4, most // slices
    if n <= most:
        return ids
    starts = [(n - width) * i // (slices - 1) for i in range(slices)]
    return b"".join(ids[4 * s:4 * (s + width)] for s in starts)


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, samples: int, size: int) -> bytes:
    """A zstandard dictionary over serialized ids of at most ``samples`` documents (least hash of
    doc_id and text first, copies once), each counted with at most 4,096 ids in slices spread over it; b"" if there is too little to train on.

    Hashes below a bound, set from the number of different documents so that about twice ``samples`` pass, are
    encoded where they lie: no more than that many slices meet in one task, whatever the corpus' size."""
    import zstandard
    h = F.xxhash64("doc_id", "text")
    different = docs.agg(F.approx_count_distinct(h)).first()[0]
    below = min(-2 ** 63 + 2 * samples * 2 ** 64 // max(1, different), 2 ** 63 - 1)
    chosen = docs.select("text", h.alias("h")).where(F.col("h") <= F.lit(below)).groupBy("h").agg(F.first("text").alias("text"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, end = _encoder(tokenizer), struct.pack("<I", end_id)
        for b in batches:
            yield pd.DataFrame({"h": b["h"], "ids": [spread_slices(enc.ids(t) + end) for t in b["text"]]})

    rows = [r["ids"] for r in chosen.mapInPandas(encode, "h long, ids binary").orderBy("h").limit(samples).collect()]
    try:
        return zstandard.train_dictionary(size, [bytes(r) for r in rows]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
                 level: int = 3, samples: int = 1000, dictionary_bytes: int = 65536, path: str | None = None) -> str:
    """Encode whole texts and write shard files in ascending doc_id order; returns the folder.

    Rows are range-partitioned by (doc_id, text hash) and sorted; a task streams its
    rows into one file, holding compressed frames only.  The dictionary is trained on
    a bounded sample (``samples`` documents); every document is written.  Null and
    empty texts have the end id alone.  Null doc_ids come first and are marked in
    the index; repeated rows are all written.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    rows = documents(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    trained = train_dictionary(rows, tokenizer, end_id, samples, dictionary_bytes)
    folder, base = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    folder.create_dir(f"{base}/data", recursive=True)
    with folder.open_output_stream(f"{base}/dictionary") as f:
        f.write(trained)
    shared = spark.sparkContext.broadcast(trained)          # at most dictionary_bytes

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        enc, end = _encoder(tokenizer), struct.pack("<I", end_id)
        words = shared.value
        extra = {"dict_data": zstandard.ZstdCompressionDict(words)} if words else {}
        press = zstandard.ZstdCompressor(level=level, **extra)
        index, frames, at, tokens = [], [], 0, 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = enc.ids(text.as_py()) + end
                frames.append(press.compress(ids))
                index.append((doc_id or 0, doc_id is None, len(ids) // 4, at))
                at += len(frames[-1])
                tokens += len(ids) // 4
        if not index:
            return
        name = f"data/{uuid.uuid4().hex}.vtok"
        fs, root = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        with fs.open_output_stream(f"{root}/{name}") as f:
            f.write(struct.pack(HEAD, MAGIC, hashlib.sha256(words).digest(), len(index)))
            f.write(np.array(index, INDEX).tobytes())
            for x in frames:
                f.write(x)
        first = next((i for i in index if not i[1]), None)
        yield pa.RecordBatch.from_pydict({
            "file": [name], "part": pa.array([_task()], pa.int32()), "first_id": pa.array([first and first[0]], pa.int64()),
            "n_docs": pa.array([len(index)], pa.int64()), "n_tokens": pa.array([tokens], pa.int64())})

    ordered = (rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
               .select("doc_id", "text"))
    files = ordered.mapInArrow(write, "file string, part int, first_id long, n_docs long, n_tokens long")
    files.write.parquet(f"{path}/manifest")
    return path


def _task() -> int:
    from pyspark import TaskContext
    return TaskContext.get().partitionId()


def read_tokens(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of the manifest's files; ids are u32 bytes.

    ``start`` counts the ids of all documents before it: files' totals are summed in
    order (one row a file), then documents inside a file."""
    schema = "file string, part int, first_id long, n_docs long, n_tokens long"
    manifest = spark.read.schema(schema).parquet(f"{path}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = write_table(manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"),
                                        "n_docs"), "files")
    root = path if "://" in path or path.startswith("file:") else f"file://{path}"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        fs, at = pafs.FileSystem.from_uri(root)
        with fs.open_input_stream(f"{at}/dictionary") as f:
            words = f.read()
        extra = {"dict_data": zstandard.ZstdCompressionDict(words)} if words else {}
        press = zstandard.ZstdDecompressor(**extra)
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with fs.open_input_stream(f"{at}/{name}") as f:
                    magic, sha, n = struct.unpack(HEAD, f.read(HEAD_BYTES))
                    if magic != MAGIC or sha != hashlib.sha256(words).digest():
                        raise ValueError(f"{name}: not a token file of this dictionary")
                    index = np.frombuffer(f.read(n * INDEX.itemsize), INDEX)
                    starts = base + np.concatenate([[0], np.cumsum(index["n"])[:-1]]).astype("i8")
                    lengths = np.diff(index["at"], append=0).astype("i8")
                    for lo in range(0, n, 256):
                        hi = min(lo + 256, n)
                        ids = [press.decompress(f.read(int(x)) if i + lo < n - 1 else f.read(),
                                                max_output_size=int(index["n"][lo + i]) * 4)
                               for i, x in enumerate(lengths[lo:hi])]
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(index["doc_id"][lo:hi], pa.int64(), mask=index["null"][lo:hi] == 1),
                            "start": pa.array(starts[lo:hi], pa.int64()),
                            "n_tokens": pa.array(index["n"][lo:hi].astype("i8"), pa.int64()),
                            "ids": pa.array(ids, pa.binary()),
                            "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64())})

    spread = files.repartition(max(1, files.count()), "file")      # one row a file; a number of its own is not coalesced
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")


def read_document(path: str, file: str, row: int) -> np.ndarray:
    """The ids of one document by index row: reads the header, one index row and one frame."""
    import zstandard
    fs, at = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    with fs.open_input_stream(f"{at}/dictionary") as f:
        words = f.read()
    extra = {"dict_data": zstandard.ZstdCompressionDict(words)} if words else {}
    with fs.open_input_file(f"{at}/{file}") as f:
        _, _, n = struct.unpack(HEAD, f.read(HEAD_BYTES))
        f.seek(HEAD_BYTES + row * INDEX.itemsize)
        rows = np.frombuffer(f.read(INDEX.itemsize * min(2, n - row)), INDEX)
        start = HEAD_BYTES + n * INDEX.itemsize
        f.seek(start + int(rows["at"][0]))
        frame = f.read(int(rows["at"][1] - rows["at"][0])) if len(rows) > 1 else f.read()
    return np.frombuffer(zstandard.ZstdDecompressor(**extra).decompress(
        frame, max_output_size=int(rows["n"][0]) * 4), "<u4")
