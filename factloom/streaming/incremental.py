"""Incremental documentation: new prompts are completed as they arrive, done ones are skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..plans import prompts as P


def document_stream(spark: SparkSession, source: str, target: str, checkpoint: str, completer: P.Completer, workers: int | None = None) -> StreamingQuery:
    """Prompts in Parquet files below ``source`` are completed once per key and appended to ``target``.

    A batch that is run again after a failure finds its own keys in the target and adds nothing.
    """
    columns = [f for f in schemas.PROMPTS.fields if f.name != "response"]
    stream = spark.readStream.schema(type(schemas.PROMPTS)(columns)).parquet(source)

    def upsert(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        try:
            done = session.read.schema(schemas.PROMPTS).parquet(target)
            done.limit(1).count()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            done = None
        P.document(batch, done, completer, workers).write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def line_counts(spark: SparkSession, source: str) -> DataFrame:
    """Running line counts of text files as they arrive."""
    lines = spark.readStream.text(source, recursiveFileLookup=True).withColumn("file", F.col("_metadata.file_name"))
    return lines.groupBy("file").agg(F.count("*").alias("lines"))
