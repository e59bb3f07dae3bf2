"""Compression classifier: how much better does a text compress with a dictionary of good texts than of bad ones?"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.llm.common import documents

#: Texts are compressed in blocks of this many bytes, so that a dictionary weighs as much at a text's end as at its start.
BLOCK = 2048


def blocks(text: bytes) -> list[bytes]:
    return [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)] or [b""]


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and a logistic calibration; small enough to travel with every task."""

    good: bytes
    bad: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[0] + ((x - np.array(self.centre)) / np.array(self.scale)) @ np.array(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Sizer:
    """Compressed sizes of whole texts, as fractions of their own: (bad - good), good, without a dictionary."""

    def __init__(self, good: bytes, bad: bytes, level: int = 3):
        import zstandard as z
        self.press = [z.ZstdCompressor(level=level, write_content_size=False, **({"dict_data": z.ZstdCompressionDict(d)} if d else {}))
                      for d in (good, bad, b"")]

    def __call__(self, text: str) -> tuple[float, float, float]:
        raw = text.encode()
        good, bad, plain = (sum(len(p.compress(b)) for b in blocks(raw)) for p in self.press)
        n = len(raw) + 50
        return (bad - good) / n, good / n, plain / n


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained on the samples; their plain concatenation where they are too few to train on."""
    import zstandard as z
    try:
        return z.train_dictionary(size, samples).as_bytes()
    except (z.ZstdError, ValueError):
        return b"".join(samples)[:size]


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    centre, scale = x.mean(0), x.std(0) + 1e-6
    a = np.c_[np.ones(len(x)), (x - centre) / scale]
    w, ridge = np.zeros(a.shape[1]), 1e-2 * len(x) ** 0.5
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -2, 2)
    return centre, scale, w


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", per_class: int = 1500, pieces: int = 4, calibration: int = 4000,
                dictionary_bytes: int = 65536) -> QualityModel:
    """Learn from labelled rows whose crc32(doc_id as text) mod 5 is not 0.

    Bounded samples (documented parameters; least hash of doc_id first): up to
    ``per_class`` texts of each class give up to ``pieces`` blocks each, spread over
    the text, to the dictionaries; up to ``calibration`` other texts, in the classes'
    natural shares, give the logistic calibration.  Null labels and ids are left out;
    rows that repeat a labelled doc_id are used as they are.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))).withColumn(
        "h", F.xxhash64(F.lit("quality"), "doc_id"))
    # The ids of the samples (bounded), then their texts: a join on few ids, whatever the corpus.
    def first(rows: DataFrame, n: int) -> DataFrame:
        return rows.orderBy("h", "doc_id").limit(n)
    odd = F.pmod("h", F.lit(3)) == 0
    train = first(known.where(~odd & (F.col("y") == 1)), per_class).unionByName(
        first(known.where(~odd & (F.col("y") == 0)), per_class)).withColumn("use", F.lit("train"))
    fit = first(known.where(odd), calibration).withColumn("use", F.lit("fit"))
    chosen = [(r["doc_id"], r["y"], r["use"]) for r in train.unionByName(fit).select("doc_id", "y", "use").collect()]
    spark = docs.sparkSession
    few = spark.createDataFrame(chosen, "doc_id long, y int, use string") if chosen else train.select("doc_id", "y", "use").limit(0)
    texts = documents(docs, id_col, text_col).join(F.broadcast(few), "doc_id")      # at most 2 * per_class + calibration ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(y, p) for y, t in zip(b["y"], b["text"]) for p in _spread(blocks(t.encode()), pieces)]
            yield pd.DataFrame(rows, columns=["y", "piece"])

    samples = texts.where(F.col("use") == "train").select("y", "text").mapInPandas(cut, "y int, piece binary").collect()
    by_class = {c: sorted(bytes(r["piece"]) for r in samples if r["y"] == c) for c in (0, 1)}
    good, bad = _dictionary(by_class[1], dictionary_bytes), _dictionary(by_class[0], dictionary_bytes)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = Sizer(good, bad)
        for b in batches:
            yield pd.DataFrame([(y, *size(t)) for y, t in zip(b["y"], b["text"])], columns=["y", "a", "b", "c"])

    got = texts.where(F.col("use") == "fit").select("y", "text").mapInPandas(
        measure, "y int, a double, b double, c double").collect()
    if not got:
        return QualityModel(good, bad, (0.0,) * 3, (1.0,) * 3, (0.0,) * 4)
    table = np.array(sorted(tuple(r) for r in got), float)
    centre, scale, w = _fit_logistic(table[:, 1:], table[:, 0])
    return QualityModel(good, bad, tuple(centre), tuple(scale), tuple(w))


def _spread(parts: list[bytes], n: int) -> list[bytes]:
    return [parts[i * len(parts) // n] for i in range(n)] if len(parts) > n else parts


def held_out(doc_id) -> "F.Column":
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted): every whole text scored, one row per input row.

    Null and empty texts are scored as texts of no bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = Sizer(model.good, model.bad)
        for b in batches:
            x = np.array([size(t.as_py()) for t in b.column(1)], float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x), pa.float64())], ["doc_id", "score"])

    rows = documents(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``threshold`` or more; no shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = Sizer(model.good, model.bad)
        for b in batches:
            x = np.array([size(t.as_py() or "") for t in b.column(at)], float).reshape(-1, 3)
            yield b.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
