"""Packing of documents into token sequences by power-of-two decomposition.

A document of n tokens becomes whole pieces of ``longest`` tokens and one piece for each
binary digit of the rest, longest first.  Every piece is a sequence of its own, of a
power-of-two length, in the bucket of its length: no sequence crosses documents and
nothing is padded.  A training loop takes its batches from one bucket at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veriscope.llm.bpe import byte_bpe
from veriscope.llm.common import documents, write_table
from veriscope.session import scratch_path

#: Bytes of ids that a task holds before it hands a batch on.
BATCH_BYTES = 8 << 20
PIECE = "part int, pos long, doc_id long, start long, doc_tokens long, length int, ids binary"


def piece_lengths(n: int, longest: int) -> list[int]:
    """Lengths of a document's pieces: as many of ``longest`` as fit, then the binary digits of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def write_sequences(docs: DataFrame, tokenizer: str, longest: int = 2048, end_id: int = 1, id_col: str = "doc_id",
                    text_col: str = "text", path: str | None = None) -> str:
    """Encode whole texts, cut them, and write one folder of Parquet files for each length; returns the path.

    ``longest`` is a power of two.  Null and empty texts have the end id alone, as one
    piece of length 1.  Null ids stay null; repeated rows are all written.  Documents
    are neither sorted nor shuffled: a task writes the pieces of its own documents and
    numbers them within each length (``part``, ``pos``), so a hot source or a very long
    text moves no other row, and a repeated attempt writes the same rows.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    path = path or scratch_path(docs.sparkSession, "sequences")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc, part = byte_bpe(tokenizer), TaskContext.get().partitionId()
        numbers: dict[int, int] = {}
        rows, held = [], 0

        def flush() -> pa.RecordBatch:
            pos, doc_id, start, total, length, ids = zip(*rows)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part] * len(rows), pa.int32()), "pos": pa.array(pos, pa.int64()),
                "doc_id": pa.array(doc_id, pa.int64()), "start": pa.array(start, pa.int64()),
                "doc_tokens": pa.array(total, pa.int64()), "length": pa.array(length, pa.int32()),
                "ids": pa.array(ids, pa.binary())})

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.array([*enc.ids(text.as_py()), end_id], "<u4")
                at = 0
                for n in piece_lengths(len(ids), longest):
                    pos = numbers.get(n, 0)
                    numbers[n] = pos + 1
                    rows.append((pos, doc_id, at, len(ids), n, ids[at:at + n].tobytes()))
                    at += n
                    held += 4 * n + 64
                    if held >= BATCH_BYTES:
                        yield flush()
                        rows, held = [], 0
        if rows:
            yield flush()

    read = documents(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    (read.mapInArrow(cut, PIECE).write.partitionBy("length").option("compression", "zstd").parquet(path))
    return path


def read_bucket(spark, path: str, length: int) -> DataFrame:
    """The sequences of one length; only that bucket's files are read."""
    return spark.read.schema(PIECE).parquet(path).where(F.col("length") == length)


def sequences(spark, path: str) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every written piece.

    Sequences are numbered without gaps from 0, bucket after bucket from the shortest
    length up.  The numbers before each (bucket, task) come from one count per bucket
    and task; the ids are never shuffled for it.
    """
    pieces = spark.read.schema(PIECE).parquet(path)
    counts = write_table(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    buckets = counts.groupBy("length").agg(F.sum("n").alias("n"))              # one row a power of two
    shorter = F.sum("n").over(Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1))
    buckets = buckets.select(F.col("length").alias("b_length"), F.coalesce(shorter, F.lit(0)).alias("bucket_base"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = (counts.withColumn("before", F.coalesce(before, F.lit(0)))
             .join(F.broadcast(buckets), F.col("length") == F.col("b_length"))
             .select(F.col("length").alias("c_length"), F.col("part").alias("c_part"),
                     (F.col("bucket_base") + F.col("before")).alias("base")))
    return (pieces.join(write_table(bases, "bases"), (F.col("length") == F.col("c_length")) & (F.col("part") == F.col("c_part")))
            .select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids", "doc_tokens",
                    (F.col("base") + F.col("pos")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
