"""Intermediate tables in the shared folder: lineage ends at a written table, never at a local checkpoint."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a folder of its own; on a cluster it is an error, since a
    machine's own folder would be lost with the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="factloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "t", folder: str | None = None) -> DataFrame:
    """The same rows read from a Parquet table in the shared folder, or in one that the caller will remove."""
    spark = df.sparkSession
    path = f"{folder or work_dir(spark)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, path: str, buckets: int, keys: Sequence[str], sort: Sequence[str] = ()) -> DataFrame:
    """The same rows as a table of files by bucket, one file each: joins on the keys don't move them."""
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", path).option("compression", "zstd")
    if sort:
        writer = writer.sortBy(*sort)
    name = f"bucketed_{uuid.uuid4().hex}"
    writer.saveAsTable(name)
    return _taken(df.sparkSession, name)


def reopened(spark: SparkSession, path: str, schema: str, buckets: int, keys: Sequence[str]) -> DataFrame:
    """A table that ``bucketed`` has written before, maybe in another session."""
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({', '.join(keys)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return _taken(spark, name)


def _taken(spark: SparkSession, name: str) -> DataFrame:
    """The catalogue is needed only to learn the layout: the entry goes, the files stay."""
    df = spark.table(name)
    df.schema
    spark.sql(f"DROP TABLE {name}")
    return df


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; one that exists is an error, so two writers can't both succeed."""
    p, fs = _file(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()


def get_text(spark: SparkSession, path: str) -> str:
    p, fs = _file(spark, path)
    stream = fs.open(p)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def names(spark: SparkSession, path: str) -> list[str]:
    """What stands in a folder; nothing where there is none."""
    p, fs = _file(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _file(spark, path)
    fs.delete(p, True)
