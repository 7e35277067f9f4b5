"""What the operators of this subpackage share: the shared work folder, row keys, table paths."""

from __future__ import annotations

import base64
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import store
from ..store import work_dir, written

__all__ = ["WORD", "column", "load_arrays", "partitions", "save_arrays", "size_in_bytes", "table", "tag", "work_dir", "written"]

#: One word of a text: neither space nor 0x09-0x0D, in Java's and RE2's notation alike.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tag(doc: str, text: str) -> Column:
    """64 bits that tell rows with one id apart; equal rows share it, and all results with it."""
    return F.xxhash64(F.col(doc), F.col(text))


def save_arrays(spark: SparkSession, path: str, **arrays: np.ndarray) -> None:
    """Arrays of a model as one small file in the shared folder; an existing one is an error."""
    raw = io.BytesIO()
    np.savez_compressed(raw, **arrays)
    store.put_text(spark, path, base64.b64encode(raw.getvalue()).decode())


def load_arrays(spark: SparkSession, path: str) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(base64.b64decode(store.get_text(spark, path)))) as found:
        return dict(found)


def size_in_bytes(df: DataFrame) -> int:
    """What the optimiser knows of a table's size, from its files; 0 where it knows nothing."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 50 else 0


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
