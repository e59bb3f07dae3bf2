"""Scan helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from veriscope.session import scratch_path


def spread(df: DataFrame, factor: int = 4) -> DataFrame:
    """Round-robin a scan that has fewer splits than the cluster has cores.

    Large inputs arrive in many splits and are left alone (no shuffle); a small
    file with a single row group would otherwise run every operator in one task."""
    sc = df.sparkSession.sparkContext
    if df.rdd.getNumPartitions() < sc.defaultParallelism:
        return df.repartition(sc.defaultParallelism * factor)
    return df


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and open the written table.

    Everything behind it runs once and survives lost executors, and later joins know
    its true size, so Spark broadcasts it only below ``autoBroadcastJoinThreshold``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
