"""Sinks: JSON lines in a directory (one part file for each task), and single files for small results."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame


def append_jsonl(df: DataFrame, path: str) -> None:
    """Appends rows as JSON lines; nulls are left out."""
    df.write.mode("append").json(path)


def overwrite_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def exists(df_or_spark, path: str) -> bool:
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def write_json(value: dict, path: str) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False) + "\n")


def write_text(value: str, path: str) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(value)
