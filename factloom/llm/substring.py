"""Substring deduplication over words with a log-structured fingerprint index.

The index is a folder: immutable runs of window fingerprints, a log of texts, and manifests, of which
the newest counts.  A run is bucketed and sorted by anchor, so a new batch is merge-joined with history
without moving history.  It holds each distinct segment of its batch once (see ``winnow``: neighbouring
windows with one anchor), with the first document that has it.  Candidates are verified on their words:
a segment matches when the 128-bit digests of all its words agree, and where an anchor has several
segments, their windows are read again from the log and compared by the digests of their words.  Runs
of one level are compacted into one of the next.
"""

from __future__ import annotations

import json
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import store
from . import winnow
from .common import column, partitions, table, work_dir, written

WINDOW = 50
GRAM = 16
#: The query indexes its table in so many batches, enough for runs to be compacted on the way.
BATCHES = 4
#: More runs than this on a level are merged into one of the next level.
FANOUT = 2
_LAST = (1 << 63) - 1
_RUN = "anchor bigint, content bigint, check bigint, doc bigint, row bigint, place bigint"


class FingerprintIndex:
    """An index below ``path``, new or reopened.

    ``append`` takes (id, text) rows, returns their results against all batches before and each other,
    and adds them.  Ids of later batches should be larger: a document is compared with smaller ids only,
    and results that were given are not taken back.
    """

    def __init__(self, spark: SparkSession, path: str, window: int = WINDOW, gram: int = GRAM, buckets: int | None = None, id_type: str = "bigint"):
        self.spark, self.path = spark, path
        known = [x for x in store.names(spark, path) if x.startswith("manifest-")]
        if known:
            state = json.loads(store.get_text(spark, f"{path}/{known[-1]}"))
            if (state["window"], state["gram"]) != (window, gram):
                raise ValueError(f"the index has windows of {state['window']} and grams of {state['gram']} words")
        else:
            if window - gram + 1 > 255:
                raise ValueError("a segment's windows must fit in 8 bits")
            state = {"version": 0, "window": window, "gram": gram, "buckets": buckets or partitions(spark), "id_type": id_type, "made": 0, "runs": [], "texts": []}
        self.state = state

    def _named(self, kind: str) -> str:
        # A number of its own even if an append failed half-way: what no manifest names is never read.
        self.state["made"] += 1
        return f"{kind}-{self.state['version']:06d}-{self.state['made']:06d}-{np.random.default_rng().integers(1 << 32):08x}"

    def _commit(self) -> None:
        self.state["version"] += 1
        store.put_text(self.spark, f"{self.path}/manifest-{self.state['version']:06d}.json", json.dumps(self.state))

    def _run(self, name: str) -> DataFrame:
        return store.reopened(self.spark, f"{self.path}/{name}", _RUN, self.state["buckets"], ["anchor"])

    def _texts(self, name: str) -> DataFrame:
        return store.reopened(self.spark, f"{self.path}/{name}", f"_row bigint, _id {self.state['id_type']}, _doc bigint, _text string", self.state["buckets"], ["_row"])

    def _write(self, rows: DataFrame, level: int) -> DataFrame:
        """A run of distinct segments, summed before the shuffle; all rows of an anchor lie in one bucket."""
        first = rows.groupBy("anchor", "content", "check").agg(F.min(F.struct("doc", "row", "place")).alias("first"))
        name = self._named("run")
        run = store.bucketed(first.select("anchor", "content", "check", "first.*"), f"{self.path}/{name}", self.state["buckets"], ["anchor"], ["anchor", "content"])
        self.state["runs"].append([name, level])
        return run

    def compact(self) -> int:
        """Merge the runs of each level that has too many; how many merges there were."""
        merges, level = 0, 0
        while any(at >= level for _, at in self.state["runs"]):
            old = [name for name, at in self.state["runs"] if at == level]
            if len(old) > FANOUT:
                rows = self._run(old[0])
                for name in old[1:]:
                    rows = rows.union(self._run(name))
                self._write(rows, level + 1)
                self.state["runs"] = [r for r in self.state["runs"] if r[0] not in old]
                self._commit()
                for name in old:
                    store.remove(self.spark, f"{self.path}/{name}")
                merges += 1
            level += 1
        return merges

    def append(self, docs: DataFrame) -> DataFrame:
        """(_id, n_words, n_removed, kept) of the rows (_id, _doc, _text), which are then part of the index."""
        window, gram, buckets = (self.state[k] for k in ("window", "gram", "buckets"))
        number = len(self.state["texts"])
        if number >= 1 << 24:
            raise ValueError("too many batches")
        runs = [self._run(name) for name, _ in self.state["runs"]]
        logs = [self._texts(name) for name in self.state["texts"]]
        name = self._named("texts")
        # The number is made once, when the log is written, and is exact: no two rows share it.
        rows = docs.select(F.monotonically_increasing_id().alias("_row"), "_id", "_doc", "_text")
        log = store.bucketed(rows, f"{self.path}/{name}", buckets, ["_row"])
        self.state["texts"].append(name)
        # What serves this batch only goes when it is done.
        scratch = work_dir(self.spark)
        segments = written(_segments(log, window, gram, number), "segments", scratch)
        fresh = self._write(segments, 0)
        verdict = written(_verdict(fresh, runs), "verdict", scratch)
        # Segments that an earlier document has go whole; others with a shared anchor are opened.
        judged = segments.join(verdict, ["anchor", "content", "check"])
        judged = written(judged.where("first < doc OR open").select("anchor", "doc", "row", "place", "first"), "judged")
        wanted = judged.where("first >= doc").select("anchor", "row", "place")
        opened = verdict.where("open").select("anchor").distinct()
        for run in runs:
            wanted = wanted.union(run.join(opened, "anchor", "left_semi").select("anchor", "row", "place"))
        wanted = written(wanted, "wanted", scratch)
        windows = _windows(log, wanted, window, number)
        for i, old in enumerate(logs):
            windows = windows.union(_windows(old, wanted, window, i))
        windows = written(windows, "windows")
        key = ["anchor", "w1", "w2"]
        least = windows.groupBy(*key).agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").drop("last")
        single = windows.where(F.col("log") == number).join(least, key).where("first < doc").select("row", _place(F.col("start"), 1).alias("place"))
        removed = judged.where("first < doc").select("row", "place").union(single)
        store.remove(self.spark, scratch)
        self._commit()
        self.compact()
        return _finish(log, removed, window)


def _place(start, count):
    """32 bits of start, 24 of the log's number and 8 of the number of windows."""
    return F.shiftleft(start.cast("long"), 32) + count


def _segments(log: DataFrame, window: int, gram: int, number: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in winnow.pieces(batch, "_text"):
                t = winnow.texts(column(part, "_text"))
                w = winnow.words(t)
                s = winnow.word_segments(winnow.word_hashes(t, w), w, window, gram)
                line = winnow.spaced(t, w)
                content, check = winnow.digests(line.raw, line.start[s.first], line.end[s.first + s.count + window - 2])
                doc, row = column(part, "_doc").to_numpy(), column(part, "_row").to_numpy()
                arrays = [s.anchor.view(np.int64), content, check, doc[s.doc], row[s.doc], (s.start << 32) | (number << 8) | s.count]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["anchor", "content", "check", "doc", "row", "place"])

    return log.select("_doc", "_row", "_text").mapInArrow(run, _RUN)


def _verdict(fresh: DataFrame, runs: list[DataFrame]) -> DataFrame:
    """(anchor, content, check, first, open) of a batch's distinct segments; bucketed alike, so no run moves."""
    name = F.struct("content", "check")
    span = lambda r, lo, hi: r.groupBy("anchor").agg(F.min(name).alias(lo), F.max(name).alias(hi))
    verdict = fresh.select("anchor", "content", "check", F.col("doc").alias("first")).join(span(fresh, "lo", "hi"), "anchor")
    for run in runs:
        seen = run.select("anchor", "content", "check", F.col("doc").alias("seen"))
        verdict = verdict.join(seen, ["anchor", "content", "check"], "left").join(span(run, "lo2", "hi2"), "anchor", "left")
        verdict = verdict.select("anchor", "content", "check", F.least("first", "seen").alias("first"), F.least("lo", "lo2").alias("lo"), F.greatest("hi", "hi2").alias("hi"))
    return verdict.select("anchor", "content", "check", "first", (F.col("lo") < F.col("hi")).alias("open"))


def _windows(log: DataFrame, wanted: DataFrame, window: int, number: int) -> DataFrame:
    """(anchor, w1, w2, doc, row, log, start) of every window of the wanted segments (anchor, row, place) of one log."""
    here = F.shiftrightunsigned("place", 8).bitwiseAND(0xFFFFFF) == number
    lists = wanted.where(here).groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("place", "anchor")).alias("list"))
    rows = log.join(lists, "_row").select("_doc", "_row", "_text", F.col("list.place").alias("places"), F.col("list.anchor").alias("anchors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in winnow.pieces(batch, "_text"):
                t = winnow.texts(column(part, "_text"))
                w = winnow.words(t)
                line = winnow.spaced(t, w)
                doc, row = column(part, "_doc").to_numpy(), column(part, "_row").to_numpy()
                places, anchors = column(part, "places"), column(part, "anchors")
                place, anchor = places.flatten().to_numpy(), anchors.flatten().to_numpy()
                owner = np.repeat(np.arange(part.num_rows), np.diff(places.offsets.to_numpy()))
                count = place & 0xFF
                begin = np.repeat(np.cumsum(count) - count, count)
                start = np.repeat(place >> 32, count) + np.arange(len(begin)) - begin
                owner, anchor = np.repeat(owner, count), np.repeat(anchor, count)
                at = w.first[owner] + start
                w1, w2 = winnow.digests(line.raw, line.start[at], line.end[at + window - 1])
                arrays = [anchor, w1, w2, doc[owner], row[owner], np.full(len(at), number, np.int32), start]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["anchor", "w1", "w2", "doc", "row", "log", "start"])

    return rows.mapInArrow(run, "anchor long, w1 long, w2 long, doc long, row long, log int, start long")


def _finish(log: DataFrame, removed: DataFrame, window: int) -> DataFrame:
    """removed: (row, place) of segments or windows whose words go."""
    lists = removed.groupBy(F.col("row").alias("_row")).agg(F.collect_list("place").alias("places"))
    rows = log.join(lists, "_row", "left").select("_id", "_text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in winnow.pieces(batch, "_text"):
                t = winnow.texts(column(part, "_text"))
                w = winnow.words(t)
                places = column(part, "places")
                lengths = np.diff(places.offsets.to_numpy())
                if places.null_count:
                    lengths = np.where(places.is_null().to_numpy(zero_copy_only=False), 0, lengths)
                place = places.flatten().to_numpy()
                owner = np.repeat(np.arange(part.num_rows), lengths)
                start = w.first[owner] + (place >> 32)
                gone = winnow.covered(len(w.start), start, start + (place & 0xFF) + window - 1)
                counts = np.concatenate([[0], np.cumsum(gone)])
                n_removed = counts[w.first[1:]] - counts[w.first[:-1]]
                raw = t.data.tobytes()
                kept = []
                a, b = w.start.tolist(), w.end.tolist()
                stay = np.flatnonzero(~gone)
                cut = np.searchsorted(stay, w.first)
                for x, y in zip(cut.tolist(), cut[1:].tolist()):
                    kept.append(b" ".join([raw[a[i] : b[i]] for i in stay[x:y].tolist()]))
                yield pa.RecordBatch.from_arrays(
                    [column(part, "_id"), pa.array(np.diff(w.first).astype(np.int64)), pa.array(n_removed.astype(np.int64)), pa.array(kept, pa.binary()).cast(pa.string(), safe=False)],
                    ["_id", "n_words", "n_removed", "kept"],
                )

    schema = T.StructType([log.schema["_id"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return rows.mapInArrow(run, schema)


def batch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows as ``FingerprintIndex.append`` takes them; a null id counts as larger than any."""
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("_doc"), F.col(text_col).alias("_text"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, batches: int = BATCHES, path: str | None = None) -> DataFrame:
    """(id, n_words, n_removed, kept): words that an earlier document's window covers are removed.

    Batches are ranges of ids in ascending order, so history always has the smaller ids.  Null and
    empty texts have no words.  Rows with one id are never compared with each other; a null id counts
    as larger than any.  Repeated rows get equal results; other columns are not read.
    """
    spark = docs.sparkSession
    rows = batch(docs, id_col, text_col)
    cuts = rows.approxQuantile("_doc", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    cuts = sorted({int(c) for c in cuts})
    index = FingerprintIndex(spark, path or f"{work_dir(spark)}/index", window, gram, id_type=docs.schema[id_col].dataType.simpleString())
    out = None
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        inside = F.lit(True)
        if lo is not None:
            inside = inside & (F.col("_doc") > lo)
        if hi is not None:
            inside = inside & (F.col("_doc") <= hi)
        done = index.append(rows.where(inside))
        out = done if out is None else out.union(done)
    return out.withColumnRenamed("_id", id_col)


def substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op2: all documents."""
    return dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: Brute force over every window's words: for small tables.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT n, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT n, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h),
g AS (SELECT n, list(DISTINCT p) AS gone FROM (SELECT n, unnest(range(i, i + 50)) AS p FROM h JOIN f USING (h) WHERE first < doc_id OR doc_id IS NULL AND first IS NOT NULL) GROUP BY n),
k AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END AS kept FROM d LEFT JOIN g USING (n))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
