"""Suffix-array deduplication over bytes by bucket-pointer refinement.

Positions are first put into buckets by a q-gram: that of their window's anchor (see ``winnow``), so
equal windows share a bucket and a bucket is named by content, not by rank.  Segments that are equal in
all their bytes (by 128-bit digests of these) count together, and a bucket with one distinct segment is
settled by that.  The rest is refined: positions are sorted by the bucket identifiers of q-grams at
later offsets, and the new identifiers serve the next, twice as long step, until windows of full length
are told apart on their bytes.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import store
from . import winnow
from .common import column, partitions, table, work_dir, written

WINDOW = 200
GRAM = 48
#: Buckets of at most so many distinct segments are refined in one task each; larger ones by shuffle.
BUCKET_MOST = 4096


def _doc_of(t: winnow.Texts) -> np.ndarray:
    return np.repeat(np.arange(len(t.offsets) - 1), np.diff(t.offsets))


def _segments(log: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, content, check, row, place); content and check are the digest of all bytes of the segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in winnow.pieces(batch, "_text", 1 << 18):
                t = winnow.texts(column(part, "_text"))
                s = winnow.byte_segments(t, _doc_of(t), window, gram)
                content, check = winnow.digests(t.data.tobytes(), s.first, s.first + s.count + window - 1)
                row = column(part, "_row").to_numpy()
                arrays = [s.anchor.view(np.int64), content, check, row[s.doc], (s.start << 8) | s.count]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["anchor", "content", "check", "row", "place"])

    return log.select("_row", "_text").mapInArrow(run, "anchor long, content long, check long, row long, place long")


def refine(context: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, repeated) of every window of the contexts: does it occur at another position too?

    Identifiers of 8-byte grams are the bytes themselves; each step sorts by the pair of identifiers
    at a position and at a later one, which doubles the length; the last pair overlaps.
    """
    t = winnow.texts(context)
    n = len(t.data)
    padded = np.concatenate([t.data, np.zeros(8, np.uint8)])
    bucket = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n].copy().view("<u8").ravel()
    length, counts = 8, np.diff(t.offsets)
    here = np.arange(n)
    left = np.repeat(t.offsets[1:], counts) - here  # bytes up to the end of the context
    live = np.flatnonzero(left >= window)
    # Only positions from which a full window fits, and the later offsets these need, are ranked.
    while length < window:
        step = min(length, window - length)
        need = np.zeros(n, bool)
        for offset in _offsets(window, length + step):
            need[live + offset] = True
        at = np.flatnonzero(need)
        order = np.lexsort((bucket[at + step], bucket[at]))
        a, b = bucket[at][order], bucket[at + step][order]
        new = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))]) if len(at) else np.zeros(0, np.int64)
        bucket = np.zeros(n, np.uint64)
        bucket[at[order]] = new
        length += step
    count = np.bincount(bucket[live].astype(np.int64)) if len(live) else np.zeros(0, np.int64)
    row = np.searchsorted(t.offsets, live, side="right") - 1
    return row, live - t.offsets[row], count[bucket[live].astype(np.int64)] > 1


def _offsets(window: int, length: int) -> list[int]:
    """Offsets within a window at which identifiers of this length are used by the later steps."""
    used = {0}
    size, chain = 8, []
    while size < window:
        step = min(size, window - size)
        chain.append((size, step))
        size += step
    for size, step in reversed(chain):
        if size + step <= length:
            break
        used |= {o + step for o in used}
    return sorted(used)


def _opened(log: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(anchor, row, place, context, big) for the wanted segments (anchor, row, place, big)."""
    lists = wanted.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("anchor", "place", "big")).alias("list"))
    rows = log.join(lists, "_row").select("_row", "_text", F.col("list.anchor").alias("anchors"), F.col("list.place").alias("places"), F.col("list.big").alias("bigs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in winnow.pieces(batch, "_text"):
                t = winnow.texts(column(part, "_text"))
                places = column(part, "places")
                place = places.flatten().to_numpy()
                owner = np.repeat(np.arange(part.num_rows), np.diff(places.offsets.to_numpy()))
                start = t.offsets[owner] + (place >> 8)
                length = (place & 0xFF) + window - 1
                ends = np.concatenate([[0], np.cumsum(length)])
                # Contexts leave in groups whose bytes are bounded.
                cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(1 << 23, ends[-1], 1 << 23)), [len(place)]]))
                for lo, hi in zip(cuts.tolist(), cuts[1:].tolist()):
                    offsets = ends[lo : hi + 1] - ends[lo]
                    data = t.data[np.repeat(start[lo:hi] - offsets[:-1], length[lo:hi]) + np.arange(offsets[-1])]
                    context = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
                    flat = [column(part, c).flatten().slice(lo, hi - lo) for c in ("anchors", "bigs")]
                    row = column(part, "_row").to_numpy()[owner[lo:hi]]
                    yield pa.RecordBatch.from_arrays([flat[0], pa.array(row), pa.array(place[lo:hi]), context, flat[1]], ["anchor", "row", "place", "context", "big"])

    return rows.mapInArrow(run, "anchor long, row long, place long, context binary, big boolean")


def _runs(place: np.ndarray, number: np.ndarray, row: np.ndarray, start: np.ndarray, hit: np.ndarray) -> list[np.ndarray]:
    """(row, first byte, last byte + 1 without the window) of maximal runs of repeated windows."""
    row, start = row[hit], start[hit]
    if not len(row):
        return [np.zeros(0, np.int64)] * 3
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)])
    a = np.flatnonzero(new)
    b = np.concatenate([a[1:], [len(row)]]) - 1
    p = place[row[a]]
    return [number[row[a]], (p >> 8) + start[a], (p >> 8) + start[b] + 1]


def _refined(opened: DataFrame, window: int) -> DataFrame:
    """(row, lo, hi): runs of window starts that repeat, from buckets of bounded size."""
    rows = opened.where("not big").select("anchor", "row", "place", "context")
    rows = rows.repartition(partitions(opened.sparkSession), "anchor").sortWithinPartitions("anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _whole_buckets(batches):
            context = some.column("context").combine_chunks()
            row, start, hit = refine(context, window)
            found = _runs(some.column("place").to_numpy(), some.column("row").to_numpy(), row, start, hit)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["row", "lo", "hi"])

    return rows.mapInArrow(run, "row long, lo long, hi long")


def _whole_buckets(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.Table]:
    """Tables of about ``most`` bytes of context that end where a bucket ends."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            held.append(part)
            size += int(np.diff(winnow.texts(column(part, "context")).offsets).sum())
            if size < most:
                continue
            all_rows = pa.Table.from_batches(held).combine_chunks()
            keys = all_rows.column("anchor").to_numpy()
            other = np.flatnonzero(keys != keys[-1])
            if len(other):
                cut = int(other[-1]) + 1
                yield all_rows.slice(0, cut)
                all_rows = all_rows.slice(cut)
                held = all_rows.combine_chunks().to_batches()
                size = sum(int(np.diff(winnow.texts(column(b, "context")).offsets).sum()) for b in held)
    if held:
        yield pa.Table.from_batches(held)


def _shuffled(opened: DataFrame, window: int) -> DataFrame:
    """The same for buckets of any size: the last identifiers at once, named by the digest of the window's bytes.

    They are counted with partial sums, so no bucket gathers in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                t = winnow.texts(column(part, "context"))
                place = column(part, "place").to_numpy()
                count = np.diff(t.offsets) - window + 1
                row = np.repeat(np.arange(len(count)), count)
                start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                at = t.offsets[row] + start
                w1, w2 = winnow.digests(t.data.tobytes(), at, at + window)
                arrays = [w1, w2, column(part, "row").to_numpy()[row], (place[row] >> 8) + start]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["w1", "w2", "row", "lo"])

    rows = opened.where("big").select("row", "place", "context").mapInArrow(run, "w1 long, w2 long, row long, lo long")
    # One place of every segment in a bucket is opened; a place counts once.
    again = rows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    return rows.join(again, ["w1", "w2"], "left_semi").select("row", "lo", (F.col("lo") + 1).alias("hi"))


def _finish(log: DataFrame, removed: DataFrame, window: int) -> DataFrame:
    lists = removed.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("lo", "hi")).alias("list"))
    rows = log.join(lists, "_row", "left").select("_id", "_text", F.coalesce("list.lo", F.array().cast("array<bigint>")).alias("los"), F.coalesce("list.hi", F.array().cast("array<bigint>")).alias("his"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in winnow.pieces(batch, "_text"):
                t = winnow.texts(column(part, "_text"))
                los, his = column(part, "los"), column(part, "his")
                base = np.repeat(t.offsets[:-1], np.diff(los.offsets.to_numpy()))
                gone = winnow.covered(len(t.data), base + los.flatten().to_numpy(), base + his.flatten().to_numpy() + window - 1)
                total = np.concatenate([[0], np.cumsum(gone)])
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                edges = t.offsets[:-1][np.diff(t.offsets) > 0]
                begins[edges] = gone[edges]
                spans = np.concatenate([[0], np.cumsum(begins)])
                a, b = t.offsets[:-1], t.offsets[1:]
                stay = ~gone
                kept = t.data[stay]
                cuts = np.concatenate([[0], np.cumsum(stay)])[t.offsets].astype(np.int32)
                body = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(kept.tobytes())])
                yield pa.RecordBatch.from_arrays([column(part, "_id"), pa.array(b - a), pa.array(total[b] - total[a]), pa.array(spans[b] - spans[a]), body], ["_id", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = T.StructType([log.schema["_id"], *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, bucket_most: int = BUCKET_MOST) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept binary): bytes of strings that occur anywhere else too.

    Null and empty texts have no bytes.  Rows are places of their own, so a repeated row repeats all
    its strings.  A null id is a document like others; other columns are not read.
    """
    if window - gram > 254 or gram % 8:
        raise ValueError("a segment's windows must fit in 8 bits, and a gram be a multiple of 8 bytes")
    spark = docs.sparkSession
    # Texts move once, into files by row number; what is found later is brought to them.
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    log = store.bucketed(rows, f"{work_dir(spark)}/log", partitions(spark), ["_row"])
    segments = _segments(log, window, gram)
    groups = segments.groupBy("content", "check").agg(F.count("*").alias("n"), F.first("anchor").alias("anchor"), F.min(F.struct("row", "place")).alias("one"))
    groups = written(groups, "groups")
    buckets = groups.groupBy("anchor").agg(F.count("*").alias("segments")).where("segments > 1")
    opened = groups.join(buckets, "anchor").select("anchor", "one.row", "one.place", (F.col("segments") > bucket_most).alias("big"))
    whole = segments.drop("anchor").join(groups.where("n > 1").select("content", "check"), ["content", "check"], "left_semi")
    whole = whole.select("row", F.shiftright("place", 8).alias("lo"), (F.shiftright("place", 8) + F.col("place").bitwiseAND(0xFF)).alias("hi"))
    opened = written(_opened(log, opened, window), "opened")
    removed = whole.union(_refined(opened, window)).union(_shuffled(opened, window))
    return _finish(log, removed, window).withColumnRenamed("_id", id_col)


def suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op8: all documents."""
    return dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: Brute force over every window's bytes: for small tables.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT n, i, md5(substr(x, 2 * i + 1, 400)) AS h FROM (SELECT n, x, unnest(range(0, len(x) // 2 - 199)) AS i FROM d)),
r AS (SELECT n, i FROM w JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
s AS (SELECT n, min(i) AS a, max(i) + 200 AS b FROM (SELECT n, i, sum(CASE WHEN i - p <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY n ORDER BY i) AS g FROM (SELECT n, i, lag(i) OVER (PARTITION BY n ORDER BY i) AS p FROM r)) GROUP BY n, g),
t AS (SELECT n, count(*) AS spans, sum(b - a) AS gone, list(a ORDER BY a) AS s, list(b ORDER BY a) AS e FROM s GROUP BY n)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
sha256(unhex(CASE WHEN s IS NULL THEN x ELSE array_to_string(list_transform(range(1, len(s) + 2), lambda k: substr(x, 2 * coalesce(e[k - 1], 0) + 1, 2 * (coalesce(s[k], len(x) // 2) - coalesce(e[k - 1], 0)))), '') END)) AS kept_sha256
FROM d LEFT JOIN t USING (n)
"""
