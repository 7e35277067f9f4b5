"""Mixing sources to target weights by systematic sampling.

Within a source every document has the same expected number of copies, target over source size.
Documents are ordered by size and a hash of their id; the running sum of expected copies plus one
random offset per source crosses an integer once per emitted copy.  The order by size spreads the
copies evenly over sizes, so the words taken come near the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, partitions, table, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix:7:"


def _offset(source: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(SEED), source)), 1, 8), 16, 10).cast("double") / 4294967296.0


def targets(sizes: DataFrame) -> DataFrame:
    """(_source, _null, source_size, target) from (_source, _null, size): water-filling in closed form.

    One row per source goes through one window; documents never do.  Sorted by cap over weight, the
    common level is the first one that fits under its own cap.
    """
    sums = sizes.groupBy("_null", "_source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("_null", "_source"))
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") - 1) % len(WEIGHTS))
    s = sums.withColumn("rank", rank).withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * MOST)
    s = s.withColumn("fill", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy(F.lit(0))
    before = Window.partitionBy(F.lit(0)).orderBy("fill", "rank").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * F.lit(SHARE)
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0))) / left)
    s = s.withColumn("level", F.max(F.when(F.col("level") <= F.col("fill"), F.col("level"))).over(everything))
    return s.select("_null", "_source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def copies(numbered: DataFrame) -> DataFrame:
    """(_row, _id, size, source_size, target, copies) from (_row, _id, _null, _source, size).

    A hot source is cut by range into many partitions; only their counts are summed across.
    """
    spark = numbered.sparkSession
    order = ["size", "_hash", "_id", "_row"]
    ranged = numbered.withColumn("_hash", F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("null"))))
    ranged = ranged.repartitionByRange(partitions(spark), "_null", "_source", *order).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "ranged")
    key = ["_part", "_null", "_source"]
    counts = ranged.groupBy(*key).agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("_null", "_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*key, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    within = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    per_source = targets(ranged.select("_null", "_source", "size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = lambda n: F.floor(F.col("offset") + F.col("part") * n)
    return (
        ranged.withColumn("within", within)
        .join(counts, key)
        .join(per_source, ["_null", "_source"])
        .withColumns({"rate": rate, "offset": _offset(F.col("_source")), "n": F.col("ahead") + F.col("within")})
        .withColumn("part", F.col("rate") - F.floor("rate"))
        .withColumn("copies", (F.floor("rate") + at(F.col("n")) - at(F.col("n") - 1)).cast("long"))
        .select("_row", "_id", "size", "source_size", "target", "copies")
    )


def _numbered(docs: DataFrame, id_col: str, text_col: str, source_col: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return written(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(id_col).alias("_id"),
            F.col(source_col).isNull().alias("_null"),
            F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_source"),
            F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            *[F.col(c).alias(f"_k_{c}") for c in extra],
        ),
        "numbered",
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document its size, its source's size and target, and the words that the mix takes.

    Null text has size 0; a null source is a source of its own, sorted last; rows are told apart by
    position, so repeated rows and null ids are mixed one by one.  Empty sources have target 0.
    """
    made = copies(_numbered(docs, id_col, text_col, source_col))
    return made.select(F.col("_id").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix: each row as often as it is taken (0 to 2 times).

    A null text has no size and is taken as its source's rate says; a null source is a source of its own;
    repeated rows and rows with null ids are mixed one by one; an empty table gives an empty one.
    """
    names = docs.columns
    rows = _numbered(docs, "doc_id", "text", "source", tuple(names))
    made = copies(rows.select("_row", "_id", "_null", "_source", "size")).select("_row", "copies").where("copies > 0")
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return rows.select("_row", *[f"_k_{c}" for c in names]).join(made, "_row").withColumn("_again", again).select(*[F.col(f"_k_{c}").alias(c) for c in names])


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op6: all documents."""
    return mix(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source IS NULL AS nul, coalesce(source, '') AS src, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
s AS (SELECT nul, src, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL),
r AS (SELECT *, row_number() OVER (ORDER BY nul, src) AS rank FROM s),
w AS (SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS weight, source_size * 2 AS cap FROM r),
f AS (SELECT *, cap / weight AS fill FROM w),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS lev
  FROM f WINDOW b AS (ORDER BY fill, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT nul, src, source_size, least(cap::DOUBLE, max(CASE WHEN lev <= fill THEN lev END) OVER () * weight) AS target FROM l),
n AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('mix:7:' || src), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u,
    row_number() OVER (PARTITION BY nul, src ORDER BY size, h, doc_id) AS n
  FROM d JOIN t USING (nul, src)),
c AS (SELECT *, floor(rate) + floor(u + (rate - floor(rate)) * n) - floor(u + (rate - floor(rate)) * (n - 1)) AS copies FROM n)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies FROM c
"""
