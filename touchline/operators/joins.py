"""Join helpers: no broadcast hints; Spark decides by the measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame

from touchline.session import scratch_path


def measured(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    Catalyst cannot tell the size of an aggregate beforehand. The written table
    has an exact one, so the size limit for broadcast joins applies to it: a
    small table is broadcast, a large one is joined by sort-merge, with skewed
    partitions split at run time. It also cuts the lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
