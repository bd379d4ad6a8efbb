"""File system access through Hadoop, so that any shared store works."""

from __future__ import annotations

import csv

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _path(spark, path)
    return fs.exists(hadoop_path)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, sorted; empty when there are none."""
    fs, hadoop_path = _path(spark, pattern)
    found = fs.globStatus(hadoop_path) or []
    return sorted(status.getPath().toString() for status in found)


def modified(spark: SparkSession, path: str) -> int:
    """When a file was written, in milliseconds."""
    fs, hadoop_path = _path(spark, path)
    return fs.getFileStatus(hadoop_path).getModificationTime()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _path(spark, path)
    fs.mkdirs(hadoop_path)


def delete(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _path(spark, path)
    return fs.delete(hadoop_path, True)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line of a CSV file; no other line is read."""
    fs, hadoop_path = _path(spark, path)
    stream = fs.open(hadoop_path)
    jvm = spark.sparkContext._jvm
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
    finally:
        stream.close()
    return next(csv.reader([line.lstrip("﻿")]), []) if line else []
