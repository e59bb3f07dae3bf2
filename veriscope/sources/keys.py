"""Which keys a store may hold: one Bloom filter of a fixed size for each key bucket.

A bucketed store files its rows by ``bucket`` (a hash of the key), so the key column of
one folder is that bucket's key file.  Beside it lies one filter a bucket and batch.  A
batch tests its keys against the filters in tasks and reads the key columns of only
those buckets where some key may be stored.  Filters are written before the rows they
stand for: a batch that dies in between leaves filters that say "maybe" too often, never
a stored key that is missed.  Full filters cost reading, not results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriscope.sources.scan import written

#: Bits of one bucket's filter (a power of two), and bits set for each key.
FILTER_BITS, PROBES = 1 << 17, 4
#: Batches after which the filters of a bucket are joined into one row.
COMPACT = 32
SHAPE = "bucket int, bits binary"


def bucket_of(key, buckets: int):
    """The folder a key is filed under."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _slots(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    low, high = hashes & 0xFFFFFFFF, (hashes >> 32) & 0xFFFFFFFF | 1
    return [(low + k * high) % bits for k in range(PROBES)]


def _hash(key):
    """64 bits independent of the bucket."""
    return F.xxhash64(F.lit("filter"), key)


class BucketFilters:
    """Bloom filters of a bucketed store, in Parquet beside it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, bits: int = FILTER_BITS):
        if bits & (bits - 1):
            raise ValueError("bits must be a power of two")
        self.spark, self.path, self.buckets, self.bits = spark, path, buckets, bits

    def clear(self) -> None:
        self.spark.createDataFrame([], SHAPE).write.mode("overwrite").parquet(self.path)

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(SHAPE).parquet(self.path)

    @staticmethod
    def _joined(rows: DataFrame) -> DataFrame:
        """One filter a bucket: the bitwise or of its rows, as they stream by."""
        def join(batches):
            held: dict[int, np.ndarray] = {}
            for b in batches:
                for k, x in zip(b["bucket"], b["bits"]):
                    part = np.frombuffer(x, np.uint8)
                    held[k] = held[k] | part if k in held else part
            if held:
                yield pd.DataFrame({"bucket": list(held), "bits": [x.tobytes() for x in held.values()]})
        return rows.repartition("bucket").mapInPandas(join, SHAPE)

    def add(self, keys: DataFrame, key: str = "doc_key") -> None:
        """Filters of a batch's keys, appended; joined with the older ones every ``COMPACT`` batches."""
        bits = self.bits

        def mark(batches):
            held: dict[int, np.ndarray] = {}
            for b in batches:
                for k, rows in b.groupby("bucket"):
                    own = held.setdefault(int(k), np.zeros(bits, bool))
                    for s in _slots(rows["h"].to_numpy(np.int64), bits):
                        own[s] = True
            if held:
                yield pd.DataFrame({"bucket": list(held), "bits": [np.packbits(x, bitorder="little").tobytes() for x in held.values()]})

        marked = (keys.select(bucket_of(F.col(key), self.buckets).alias("bucket"), _hash(F.col(key)).alias("h"))
                  .repartition("bucket").mapInPandas(mark, SHAPE))
        self._joined(marked).write.mode("append").parquet(self.path)
        if self._rows().count() > COMPACT * self.buckets:
            joined = written(self._joined(self._rows()), "filters")
            joined.write.mode("overwrite").parquet(self.path)

    def maybe(self, keys: DataFrame, key: str = "doc_key") -> DataFrame:
        """The keys (with their bucket) that may be stored.  The filters are broadcast: buckets x bits / 8 bytes at most."""
        rows = self._joined(self._rows()).collect()
        held = self.spark.sparkContext.broadcast({r["bucket"]: bytes(r["bits"]) for r in rows})
        bits = self.bits

        @F.pandas_udf("boolean")
        def may_hold(bucket: pd.Series, h: pd.Series) -> pd.Series:
            out = np.zeros(len(h), bool)
            for k in bucket.unique():
                if k in held.value:
                    own, at = np.frombuffer(held.value[k], np.uint8), (bucket == k).to_numpy()
                    hit = np.ones(int(at.sum()), bool)
                    for s in _slots(h.to_numpy(np.int64)[at], bits):
                        hit &= (own[s >> 3] >> (s & 7) & 1).astype(bool)
                    out[at] = hit
            return pd.Series(out)

        return (keys.select(key, bucket_of(F.col(key), self.buckets).alias("bucket"))
                .where(may_hold("bucket", _hash(F.col(key)))))


def stored_keys(store: DataFrame, maybe: DataFrame, key: str = "doc_key") -> DataFrame:
    """Those of the ``maybe`` keys that the bucketed store holds; reads the key column of their buckets only."""
    maybe = written(maybe, "maybe")
    needed = sorted(r[0] for r in maybe.select("bucket").distinct().collect())          # one row a bucket at most
    held = store.where(F.col("bucket").isin(needed)).select("bucket", key)
    return held.join(maybe, ["bucket", key], "left_semi").select(key).distinct()
