"""Near-duplicate documents by bottom-k sketches of one hash function.

Documents with one shingle set form a class.  A class keeps its k smallest shingle hashes.  Inverted
lists of retained values bring classes of similar size together; a list that is too long is split by
further retained values until it is short, so common shingles cost no pairs.  In a list the sketch of
the union estimates the similarity; what passes is verified on the full sets.

Dense groups must not be paired off.  Each class first names the smaller classes that share most
value pairs with it; these chains, and spanning forests of the lists that join several chains, gather
classes into families outside of which no pair passes the estimate.  Chains and forests are verified
first.  Inside a family only blocks of classes that this left in different components are compared, by
sketches long enough to hold most sets whole; no text travels with them, and no pair is looked at whose
components have met.

Sets of fewer than SMALL shingles are similar only if one is the other with one shingle more, which a
join on sets without one of their shingles finds.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import winnow
from .common import column, partitions, table, tag, written
from .components import components

#: Retained values per class.
K = 32
#: Pairs of the first so many values name a class's centre.
CHAINED, CENTRES = 4, 3
#: Values that start a list, and values tried for each further split.
STARTS, STEPS, DEPTH = 8, 3, 3
#: A list of more classes than this is split; one that can't be is compared in blocks of half of BLOCK.
LIST_MOST, BLOCK = 128, 1024
#: Values of the sketches that members of a family are compared by, and half the members of a meeting.
LONG, FAMILY_BLOCK = 512, 2048
#: Estimates by long sketches below this are dropped: more than five standard deviations under 0.8.
LONG_LEAST = 0.7
#: Below this size a set's partners differ from it by one shingle: 7 of 9 shingles are less than 80 %.
SMALL = 8
#: Union-sketch estimates below this are dropped: more than four standard deviations under 0.8.
ESTIMATE_LEAST = 0.44
PERCENT = 80
#: Sizes of similar sets differ by at most this factor (a little over 1 / 0.8), so by one bucket.
SIZE_STEP = 1.2501
_PAD = np.uint32(0xFFFFFFFF)


def shingles(t: winnow.Texts, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles; fewer words count as one shingle."""
    t = winnow.folded(t)
    w = winnow.words(t)
    values = winnow.word_hashes(t, w)
    n = np.diff(w.first)
    out = []
    all_hashes = winnow.sliding(values, size)
    for i, count in enumerate(n.tolist()):
        a = int(w.first[i])
        if count >= size:
            out.append(np.unique(all_hashes[a : a + count - size + 1]))
        elif count:
            out.append(winnow.sliding(values[a : a + count], count))
        else:
            out.append(all_hashes[:0])
    return out


def _sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    narrow = docs.select(F.col(id_col).alias("_id"), tag(id_col, text_col).alias("_tag"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in winnow.pieces(batch, "_text"):
                found = shingles(winnow.texts(column(part, "_text")), size)
                sums = [np.array([winnow.mix(h ^ np.uint64(c)).sum() for h in found], np.uint64).view(np.int64) for c in (0x1234567, 0x7654321)]
                sketch = [h[:K].view(np.int64) for h in found]
                yield pa.RecordBatch.from_arrays([column(part, "_id"), column(part, "_tag"), pa.array([len(h) for h in found], pa.int64()), pa.array(sums[0]), pa.array(sums[1]), pa.array(sketch, pa.list_(pa.int64()))], ["_id", "_tag", "n", "s1", "s2", "sketch"])

    schema = T.StructType([*narrow.select("_id", "_tag").schema.fields, *[T.StructField(c, T.LongType()) for c in ("n", "s1", "s2")], T.StructField("sketch", T.ArrayType(T.LongType()))])
    return narrow.mapInArrow(run, schema)


def _bucket():
    return F.floor(F.log(F.col("n")) / F.log(F.lit(SIZE_STEP))).cast("int")


def _small_links(classes: DataFrame) -> DataFrame:
    """(a, b) of all similar pairs whose smaller set has fewer than SMALL shingles: exact, and linear in the classes."""
    some = classes.where(F.col("n").between(4, SMALL)).select("cid", "n", "sketch")
    whole = some.where(F.col("n") < SMALL).select(F.col("cid").alias("a"), F.col("sketch").alias("key"))
    less = some.where("n > 4").select(F.col("cid").alias("b"), F.explode(F.transform("sketch", lambda v: F.array_remove("sketch", v))).alias("key"))
    return whole.join(less, "key").select("a", "b")


def _chains(classes: DataFrame) -> DataFrame:
    """(a, b, best): for each class the smaller ones that share most value pairs with it, if the sketches pass."""
    pairs = F.array(*[F.xxhash64(F.get("sketch", F.lit(i)), F.get("sketch", F.lit(j)), "b") for j in range(CHAINED) for i in range(j)])
    both = F.explode(F.array("b", F.col("b") + 1))
    rows = classes.select("cid", "sketch", _bucket().alias("b")).where(F.col("n") >= SMALL).select("cid", "sketch", both.alias("b"))
    rows = rows.select("cid", F.explode(pairs).alias("key"))
    centres = rows.groupBy("key").agg(F.min("cid").alias("centre"), F.count("*").alias("members")).where("members > 1").drop("members")
    votes = rows.join(centres, "key").where("centre < cid").groupBy("cid", "centre").agg(F.count("*").alias("votes"))
    ranked = F.slice(F.sort_array(F.collect_list(F.struct("votes", -F.col("centre"))), asc=False), 1, CENTRES)
    # A class has at most 2 * 6 keys, so at most as many centres.
    best = votes.groupBy("cid").agg(ranked.alias("r")).select("cid", F.posexplode("r").alias("rank", "c")).select("cid", (F.col("rank") == 0).alias("best"), (-F.col("c.col2")).alias("centre"))
    side = lambda c, key: classes.select(F.col("cid").alias(key), F.col("n").alias(f"n_{c}"), _small().alias(f"s_{c}"))
    rows = best.join(side("a", "centre"), "centre").join(side("b", "cid"), "cid").select(F.col("centre").alias("a"), F.col("cid").alias("b"), "best", "n_a", "n_b", "s_a", "s_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e = estimate(_matrix(column(batch, "s_a")), _matrix(column(batch, "s_b")), column(batch, "n_a").to_numpy(), column(batch, "n_b").to_numpy())
            ok = pa.array(e >= ESTIMATE_LEAST)
            yield pa.RecordBatch.from_arrays([column(batch, c).filter(ok) for c in ("a", "b", "best")], ["a", "b", "best"])

    return rows.mapInArrow(run, "a long, b long, best boolean")


def _lists(classes: DataFrame) -> DataFrame:
    """(key, cid, comp): lists of at most LIST_MOST classes that span components, and blocks of those that can't be split.

    classes: (cid, n, sketch, comp), sets of SMALL shingles or more.  Similar ones share a start and two
    further values at most STEPS places on, whatever their sizes.
    """
    at = classes.where(F.col("n") >= SMALL).select("cid", "comp", F.posexplode(F.slice("sketch", 1, STARTS)).alias("pos", "value"), _bucket().alias("b"))
    at = at.select("cid", "comp", "pos", F.explode(F.array(F.xxhash64("value", "b"), F.xxhash64("value", F.col("b") + 1))).alias("key"))
    done, depth = [], 1
    while True:
        counts = at.groupBy("key").agg(F.count("*").alias("members"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        known = written(at.join(counts.where("members > 1 AND lo < hi").drop("lo", "hi"), "key"), f"lists{depth}")
        done.append(known.where(F.col("members") <= LIST_MOST).select("key", "cid", "comp"))
        long = known.where(F.col("members") > LIST_MOST).select("key", "cid", "comp", "pos")
        if long.isEmpty():
            return _union(done)
        if depth >= DEPTH:
            return _union([*done, _spread(long.select("key", "cid", "comp"), BLOCK // 2)])
        # Two similar classes of a long list share a further value among the next few with certainty close to one.
        ahead = F.posexplode(F.slice("sketch", F.col("pos") + 2, STEPS)).alias("step", "value")
        at = long.join(classes.select("cid", "sketch"), "cid").select("cid", "comp", "key", "pos", ahead)
        at = at.select("cid", "comp", (F.col("pos") + 1 + F.col("step")).alias("pos"), F.xxhash64("key", "value").alias("key"))
        depth += 1


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _spread(lists: DataFrame, half: int) -> DataFrame:
    """(key, cid, comp): lists of any length as blocks of about ``half`` classes and all pairs of blocks.

    A component that fills blocks has blocks of its own, and these aren't paired with each other:
    every pair of classes of different components meets in a list, few others do.
    """
    sizes = lists.groupBy("key", "comp").agg(F.count("*").alias("own"))
    big = F.col("own") >= half
    wide = F.ceil(F.col("own") / half).cast("int")
    # Large components of a list follow each other; their number is at most its length over half.
    before = Window.partitionBy("key").orderBy("comp").rowsBetween(Window.unboundedPreceding, -1)
    large = sizes.where(big).select("key", "comp", wide.alias("wide")).withColumn("lo", F.coalesce(F.sum("wide").over(before), F.lit(0)).cast("int"))
    totals = sizes.groupBy("key").agg(F.sum(F.when(big, wide).otherwise(0)).cast("int").alias("high"), F.ceil(F.sum(F.when(~big, F.col("own")).otherwise(0)) / half).cast("int").alias("low"))
    rows = lists.join(totals, "key").join(large, ["key", "comp"], "left")
    mine = F.when(F.col("wide").isNull(), F.col("high") + F.pmod(F.xxhash64("comp", F.lit(5)), F.greatest("low", F.lit(1)))).otherwise(F.col("lo") + F.pmod(F.xxhash64("cid", F.lit(5)), "wide")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("high") + F.col("low") - 1), lambda x: F.col("wide").isNull() | (x < F.col("lo")) | (x >= F.col("lo") + F.col("wide")))
    rows = rows.select("key", "cid", "comp", mine.alias("mine"), F.explode(others).alias("other"))
    return rows.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "cid", "comp")


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Similarity of sets from the sketch of their union; exact where both sets are within k."""
    top = np.minimum(np.where(na > K, a[:, -1], _PAD), np.where(nb > K, b[:, -1], _PAD))
    merged = np.sort(np.concatenate([a, b], axis=1), axis=1)
    valid = (merged <= top[:, None]) & (merged != _PAD)
    both = ((merged[:, 1:] == merged[:, :-1]) & valid[:, 1:]).sum(axis=1)
    union = valid.sum(axis=1) - both
    return both / np.maximum(union, 1)


def _forest(pairs: list[tuple[float, int, int]]) -> list[tuple[int, int]]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    out = []
    for _, x, y in sorted(pairs, key=lambda p: (-p[0], p[1], p[2])):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def _forests(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b): of every list a spanning forest of the pairs across components that pass the estimate."""
    rows = lists.join(classes.select("cid", "n", _small().alias("sketch")), "cid").select("key", "cid", "comp", "n", "sketch")
    rows = rows.repartition(partitions(lists.sparkSession) * 2, "key").sortWithinPartitions("key", "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _whole_lists(batches):
            yield _list_forests(some)

    return rows.mapInArrow(run, "a long, b long").distinct()


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that end where a list ends; lists are short or blocks, so what is held is bounded."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        keys = held.column("key").to_numpy()
        other = np.flatnonzero(keys != keys[-1])
        if len(other):
            cut = int(other[-1]) + 1
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None:
        yield held


def _small():
    """The sketch's upper halves, which is enough to compare sketches by."""
    return F.transform("sketch", lambda v: F.shiftrightunsigned(v, 32))


def _matrix(flat: pa.ListArray) -> np.ndarray:
    sketch = np.full((len(flat), K), _PAD, np.uint32)
    lengths = np.diff(flat.offsets.to_numpy())
    sketch[np.arange(K)[None, :] < lengths[:, None]] = flat.flatten().to_numpy().astype(np.uint32)
    return sketch


def _list_forests(rows: pa.Table) -> pa.RecordBatch:
    key, cid, comp, n = (rows.column(c).to_numpy() for c in ("key", "cid", "comp", "n"))
    sketch = _matrix(rows.column("sketch").combine_chunks())
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    members = np.diff(np.concatenate([start, [len(key)]]))
    out_a, out_b = [], []
    for m in np.unique(members[members > 1]).tolist():
        heads = start[members == m]
        i, j = np.triu_indices(m, 1)
        per = max(1, 40000 // len(i))
        for h in range(0, len(heads), per):
            some = heads[h : h + per]
            a, b = (some[:, None] + i[None]).ravel(), (some[:, None] + j[None]).ravel()
            size = (100 * np.minimum(n[a], n[b]) >= PERCENT * np.maximum(n[a], n[b])) & (comp[a] != comp[b])
            owner = np.repeat(np.arange(len(some)), len(i))[size]
            a, b = a[size], b[size]
            parts = [slice(x, x + 40000) for x in range(0, len(a), 40000)]
            e = np.concatenate([estimate(sketch[a[x]], sketch[b[x]], n[a[x]], n[b[x]]) for x in parts]) if parts else np.zeros(0)
            ok = e >= ESTIMATE_LEAST
            a, b, e, owner = cid[a[ok]], cid[b[ok]], e[ok], owner[ok]
            if m > 2 and len(a):
                cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])).tolist() + [len(a)]
                for x, y in zip(cuts, cuts[1:]):
                    tree = _forest(list(zip(e[x:y].tolist(), a[x:y].tolist(), b[x:y].tolist())))
                    out_a.append(np.array([p[0] for p in tree], np.int64))
                    out_b.append(np.array([p[1] for p in tree], np.int64))
            else:
                out_a.append(a)
                out_b.append(b)
    a = np.concatenate(out_a) if out_a else np.zeros(0, np.int64)
    b = np.concatenate(out_b) if out_b else np.zeros(0, np.int64)
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _texts(docs: DataFrame, classes: DataFrame, needed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cid, blob): one compressed text for each needed class."""
    want = classes.join(needed, "cid").select("cid", F.col("rep._id").alias("w_id"), F.col("rep._tag").alias("w_tag"))
    source = docs.select(F.col(id_col).alias("_id"), tag(id_col, text_col).alias("_tag"), F.col(text_col).alias("_text"))
    got = source.join(want, F.col("_id").eqNullSafe(F.col("w_id")) & (F.col("_tag") == F.col("w_tag"))).select("cid", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, last = zstandard.ZstdCompressor(level=1), None
        for batch in batches:
            ids, blobs = [], []
            for c, x in zip(column(batch, "cid").to_pylist(), column(batch, "_text").to_pylist()):
                if c != last:  # repeated rows of a document follow each other
                    ids.append(c)
                    blobs.append(press.compress((x or "").encode("utf-8", "surrogatepass")))
                last = c
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["cid", "blob"])

    return got.mapInArrow(run, "cid long, blob binary")


def _verified(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(a, b, linked) by the full shingle sets."""
    side = lambda c: texts.select(F.col("cid").alias(c), F.col("blob").alias(f"text_{c}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        undo = zstandard.ZstdDecompressor()

        def sets(blobs: list[bytes]) -> dict[int, np.ndarray]:
            raw = pa.array([undo.decompress(x) for x in blobs], pa.binary())
            return shingles(winnow.texts(raw), size)

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                x, y = (sets(column(part, c).to_pylist()) for c in ("text_a", "text_b"))
                linked = []
                for p, q in zip(x, y):
                    both = np.intersect1d(p, q, assume_unique=True).size
                    linked.append(100 * both >= PERCENT * (len(p) + len(q) - both))
                yield pa.RecordBatch.from_arrays([column(part, "a"), column(part, "b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return rows.mapInArrow(run, "a long, b long, linked boolean")


def _long_sketches(texts: DataFrame, size: int) -> DataFrame:
    """(cid, n, long): the LONG smallest shingle hashes of each text; all of them, for most texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        undo = zstandard.ZstdDecompressor()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                raw = pa.array([undo.decompress(x) for x in column(part, "blob").to_pylist()], pa.binary())
                found = shingles(winnow.texts(raw), size)
                values = [h[:LONG].view(np.int64) for h in found]
                yield pa.RecordBatch.from_arrays([column(part, "cid"), pa.array([len(h) for h in found], pa.int64()), pa.array(values, pa.list_(pa.int64()))], ["cid", "n", "long"])

    return texts.mapInArrow(run, "cid long, n long, long array<long>")


def _settled(lists: DataFrame, sketches: DataFrame) -> DataFrame:
    """(a, b, sure) pairs that join components of a list: links by whole sets, and candidates among larger sets."""
    rows = lists.join(sketches, "cid").select("key", "cid", "comp", "n", "long")
    rows = rows.repartition(partitions(lists.sparkSession) * 2, "key").sortWithinPartitions("key", "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _whole_lists(batches):
            key = some.column("key").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])).tolist()
            for x, y in zip(cuts, cuts[1:]):
                if y - x > 1:
                    yield _settle(some.slice(x, y - x))

    return rows.mapInArrow(run, "a long, b long, sure boolean")


#: Places that values are counted in; two in one place only make an estimate larger.
_PLACES = 2048


def _settle(rows: pa.Table) -> pa.RecordBatch:
    cid, comp, n = (rows.column(c).to_numpy() for c in ("cid", "comp", "n"))
    flat = rows.column("long").combine_chunks()
    first = flat.offsets.to_numpy() - flat.offsets[0].as_py()
    values = flat.flatten().to_numpy().view(np.uint64)
    length = np.diff(first)
    top = np.where(n > LONG, values[np.maximum(first[1:] - 1, 0)], np.iinfo(np.uint64).max)
    dense = np.zeros((len(cid), _PLACES), np.float32)
    np.add.at(dense, (np.repeat(np.arange(len(cid)), length), (winnow.mix(values) % np.uint64(_PLACES)).astype(np.int64)), 1)
    label = np.unique(comp, return_inverse=True)[1]
    out: list[tuple[int, int, bool]] = []
    for lo in range(0, len(cid), 256):
        some = np.arange(lo, min(lo + 256, len(cid)))
        # Values up to the smaller of the two tops count; those of the other above it can't be shared.
        least = np.minimum(top[some][:, None], top[None, lo:])
        shared = dense[some] @ dense[lo:].T
        small = np.minimum(n[some][:, None], n[None, lo:])
        whole = (n[some][:, None] <= LONG) & (n[None, lo:] <= LONG)
        size = np.where(whole, n[some][:, None] + n[None, lo:], 2.0 * np.minimum(small, LONG))
        bound = np.where(whole, PERCENT / 100, LONG_LEAST)
        # For larger sets the union of sketches has at least as many values as one of them up to the top.
        ok = np.where(whole, shared >= bound * (size - shared), shared >= bound * np.minimum(small, LONG))
        ok &= 100 * small >= PERCENT * np.maximum(n[some][:, None], n[None, lo:])
        ok &= label[some][:, None] != label[None, lo:]
        ok &= some[:, None] < np.arange(lo, len(cid))[None, :]
        i, j = np.nonzero(ok)
        order = np.argsort(-shared[i, j], kind="stable")
        for p, q, t in zip(some[i[order]].tolist(), (j[order] + lo).tolist(), least[i, j][order].tolist()):
            if label[p] == label[q]:
                continue
            a, b = values[first[p] : first[p + 1]], values[first[q] : first[q + 1]]
            both = np.intersect1d(a, b, assume_unique=True).size
            if n[p] <= LONG and n[q] <= LONG:
                if 100 * both >= PERCENT * (len(a) + len(b) - both):
                    out.append((int(cid[p]), int(cid[q]), True))
                    label[label == label[q]] = label[p]
                continue
            t = np.uint64(t)
            union = np.searchsorted(a, t, side="right") + np.searchsorted(b, t, side="right") - both
            if both >= LONG_LEAST * union:
                out.append((int(cid[p]), int(cid[q]), False))
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.bool_()))], ["a", "b", "sure"])


def _with_components(classes: DataFrame, found: DataFrame) -> DataFrame:
    return classes.join(found, F.col("cid") == F.col("node"), "left").select("cid", "n", "sketch", F.coalesce("component", "cid").alias("comp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """(id, _tag, n_shingles, component_id, kept) of every document.

    Texts without words (null and empty ones too) have n_shingles 0 and are linked with nothing.
    Repeated rows fall into one class and get equal results.  Null ids never name a component unless
    no linked document has an id; then component_id is null and the row is kept.
    """
    rows = written(_sets(docs, id_col, text_col, shingle), "sets")
    classes = rows.where("n > 0").groupBy("s1", "s2").agg(F.min("_id").alias("least"), F.min(F.struct("_id", "_tag")).alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    sketches = classes.select("cid", "n", "sketch")
    chains = written(_chains(sketches), "chains")
    small = written(_small_links(sketches), "small")
    lists = _lists(_with_components(sketches, components(chains, "a", "b")))
    forests = written(_forests(lists, sketches), "forests")
    # Every class with a passing partner is in a chain or in a forest, and so is every passing pair in one family.
    families = written(components(chains.select("a", "b").union(forests), "a", "b"), "families")
    texts = written(_texts(docs, classes, families.select(F.col("node").alias("cid")), id_col, text_col), "texts")
    first = chains.where("best").select("a", "b").union(forests).distinct()
    links = written(_verified(first, texts, shingle).where("linked").select("a", "b"), "links")
    found = written(components(links, "a", "b"), "found")
    inside = families.select(F.col("node").alias("cid"), F.col("component").alias("key")).join(found, F.col("cid") == F.col("node"), "left").select("key", "cid", F.coalesce("component", "cid").alias("comp"))
    inside = written(inside, "inside")
    mixed = inside.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    inside = inside.join(mixed, "key", "left_semi")
    longer = written(_long_sketches(texts.join(inside.select("cid").distinct(), "cid", "left_semi"), shingle), "longer")
    settled = written(_settled(_spread(inside, FAMILY_BLOCK), longer), "settled").distinct()
    more = settled.where("sure").select("a", "b").union(_verified(settled.where("not sure").select("a", "b"), texts, shingle).where("linked").select("a", "b"))
    found = components(links.union(written(more.union(small), "more")), "a", "b")
    named = classes.select("cid", "s1", "s2", "least").join(found, F.col("cid") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "cid"))
    names = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    result = rows.join(named.join(names, "comp").select("s1", "s2", "component_id"), ["s1", "s2"], "left")
    own = F.when(F.col("n") == 0, F.col("_id")).otherwise(F.col("component_id"))
    return result.select("_id", "_tag", F.col("n").alias("n_shingles"), own.alias("component_id")).select(
        F.col("_id").alias(id_col), "_tag", "n_shingles", "component_id", F.coalesce(F.col("_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept")
    )


def minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op7: all documents, shingles of two words."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2).drop("_tag")


def first_of_each(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, one of each group of near-duplicates: that with the smallest id.

    Documents without words are in no group and stay.  Of repeated rows one stays; a row with a null id
    stays if nothing with an id is in its group.  Columns need no special names: they travel in a
    struct; an empty table gives an empty one.
    """
    kept = near_duplicates(docs, id_col, text_col, shingle).where("kept").select(F.col(id_col).alias("_kept_id"), F.col("_tag").alias("_kept_tag"))
    rows = docs.select(F.col(id_col).alias("_id"), tag(id_col, text_col).alias("_tag"), F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    left = rows.join(kept, F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_tag") == F.col("_kept_tag")), "left_semi")
    return left.dropDuplicates(["_id", "_tag"]).select("_row.*")


#: Brute force over all pairs of classes of like sizes: for small tables.
SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT n, doc_id, list_sort(list_distinct(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END)) AS x FROM d),
z AS (SELECT n, doc_id, len(x)::BIGINT AS m, list_transform(x, lambda v: hash(v)) AS x FROM s),
c AS (SELECT x, any_value(m) AS m, min(n) AS id FROM z WHERE m > 0 GROUP BY x),
l AS (SELECT a.id AS a, b.id AS b FROM c a JOIN c b ON a.id < b.id AND 100 * least(a.m, b.m) >= 80 * greatest(a.m, b.m) WHERE 180 * len(list_intersect(a.x, b.x)) >= 80 * (a.m + b.m)),
e AS (SELECT a AS u, b AS v FROM l UNION ALL SELECT b, a FROM l),
r(v, r) USING KEY (v) AS (SELECT id, id FROM c UNION SELECT e.v, min(r.r) FROM r JOIN e ON r.v = e.u JOIN recurring.r AS o ON o.v = e.v WHERE r.r < o.r GROUP BY e.v),
k AS (SELECT z.doc_id, z.m, r.r FROM z LEFT JOIN c ON z.x = c.x AND z.m > 0 LEFT JOIN r ON r.v = c.id),
g AS (SELECT r, min(doc_id) AS least FROM k WHERE r IS NOT NULL GROUP BY r)
SELECT doc_id, m AS n_shingles, CASE WHEN r IS NULL THEN doc_id ELSE least END AS component_id, coalesce(doc_id = CASE WHEN r IS NULL THEN doc_id ELSE least END, (CASE WHEN r IS NULL THEN doc_id ELSE least END) IS NULL) AS kept FROM k LEFT JOIN g USING (r)
"""
