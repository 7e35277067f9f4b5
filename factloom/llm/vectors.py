"""Near-duplicate embeddings with an inverted multi-index.

Each half of a unit vector has its own codebook; pairs of codes form a grid of cells.  A vector lives
in its nearest cell and visits further cells in the order of their summed distances (the
multi-sequence order) until the target recall; vectors that meet in a cell are compared in double
precision.  Of two cells only the one with the smaller number visits the other, so a pair is compared
once.  How many cells that takes is measured on a bounded sample, with neighbours made at the
threshold itself, the hardest ones that must be found.

Vectors of each length have a grid of their own, whose size follows the number of vectors that share a
label.  A vector moves once for its class and once for each cell it lives in or visits.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, partitions, table, written
from .components import components

LEAST = 0.93
#: Codebooks are fitted to at most so many vectors, those of the smallest hashes of their ids.
SAMPLE_ROWS = 20000
TARGET_RECALL = 0.98
#: Vectors of one label per cell that the size of the grid aims at.  Small cells are visited more often,
#: and a visit moves a vector; large ones cost comparisons.
PER_CELL = 512
#: A code needs some vectors of the sample, so codebooks have at most so many: cells for 13 thousand
#: million vectors of one label.
CODES_MOST = SAMPLE_ROWS // 4
#: Residents and visitors of a cell are compared in blocks of at most about so many.
BLOCK = 8192


class Grid(NamedTuple):
    dim: int
    books: tuple[np.ndarray, np.ndarray]
    visits: int


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([_distances(x[i : i + 1024], centres).argmin(axis=1) for i in range(0, len(x), 1024)])
        count = np.bincount(near, minlength=k)
        for d in range(x.shape[1]):
            total = np.bincount(near, x[:, d], k)
            centres[count > 0, d] = total[count > 0] / count[count > 0]
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None], 0)


def _halves(x: np.ndarray, grid: Grid) -> tuple[np.ndarray, np.ndarray]:
    half = grid.dim // 2
    return _distances(x[:, :half], grid.books[0]), _distances(x[:, half:], grid.books[1])


def _nearest(d: np.ndarray, n: int) -> np.ndarray:
    """The n nearest codes in order; equal distances by number."""
    if n < d.shape[1]:
        # What is as near as the n-th may tie with it, so one sort settles the order of the few left.
        some = np.sort(np.argpartition(d, n - 1, axis=1)[:, :n], axis=1)
        return np.take_along_axis(some, np.argsort(np.take_along_axis(d, some, 1), axis=1, kind="stable"), 1)
    return np.argsort(d, axis=1, kind="stable")


def visited(x: np.ndarray, grid: Grid) -> np.ndarray:
    """(rows, visits) cells in multi-sequence order, nearest first.

    Only codes that stand early enough in both orders can be among the first n sums: a cell of ranks
    (i, j) comes after (i + 1) * (j + 1) - 1 others.
    """
    n = grid.visits
    a, b = _halves(x, grid)
    ia, ib = _nearest(a, n), _nearest(b, n)
    i, j = np.meshgrid(np.arange(ia.shape[1]), np.arange(ib.shape[1]), indexing="ij")
    some = (i + 1) * (j + 1) <= n
    i, j = i[some], j[some]
    sums = np.take_along_axis(a, ia, 1)[:, i] + np.take_along_axis(b, ib, 1)[:, j]
    order = np.argsort(sums, axis=1, kind="stable")[:, :n]
    code = ia[:, i] * len(grid.books[1]) + ib[:, j]
    return np.take_along_axis(code, order, 1)


def ranks(x: np.ndarray, cells: np.ndarray, grid: Grid) -> np.ndarray:
    """How many cells come no later than the given one in each row's order, counted without listing cells."""
    a, b = _halves(x, grid)
    at = np.arange(len(x))
    width = len(grid.books[1])
    level = a[at, cells // width] + b[at, cells % width]
    b = np.sort(b, axis=1)
    return np.array([np.searchsorted(b[r], level[r] - a[r], side="right").sum() for r in range(len(x))])


def fit(sample: np.ndarray, rows: float, least: float = LEAST, recall: float = TARGET_RECALL) -> Grid:
    """A grid for ``rows`` vectors of a label; memory grows with the codebooks, not with the cells."""
    rng = np.random.default_rng(7)
    dim = sample.shape[1]
    codes = int(np.clip(np.ceil(np.sqrt(rows / PER_CELL)), 1, CODES_MOST))
    half = dim // 2
    # Probes are no part of what the codebooks are fitted to: those would lie too close to their codes.
    mixed = sample[rng.permutation(len(sample))]
    held = min(2000, len(sample) // 5)
    learned, probes = mixed[held:], mixed[:held] if held else mixed
    books = (_kmeans(learned[:, :half], codes, rng), _kmeans(learned[:, half:], codes, rng))
    grid = Grid(dim, books, 1)
    found = []
    for i in range(0, len(probes), 250):
        probe = probes[i : i + 250]
        noise = rng.standard_normal(probe.shape)
        noise -= (noise * probe).sum(1, keepdims=True) * probe
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-30)
        near = least * probe + np.sqrt(1 - least * least) * noise
        found.append(ranks(probe, visited(near, grid)[:, 0], grid))
    return grid._replace(visits=int(np.quantile(np.concatenate(found), recall, method="higher")))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _placed(classes: DataFrame, grids: dict[int, Grid]) -> DataFrame:
    """The classes with their cells: first the home cell, then those visited that have a larger number."""
    # Codebooks grow with the root of the table up to CODES_MOST codes, so their size is bounded.
    shared = classes.sparkSession.sparkContext.broadcast(grids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = column(batch, "dim").to_numpy()
            listed: list[np.ndarray] = [np.zeros(1, np.int64)] * batch.num_rows
            for dim, grid in shared.value.items():
                rows = np.flatnonzero(dims == dim)
                for lo in range(0, len(rows), 1024):
                    some = rows[lo : lo + 1024]
                    x = _unit(column(batch, "v").take(pa.array(some)).flatten().to_numpy().reshape(len(some), dim))
                    for r, cells in zip(some.tolist(), visited(x, grid)):
                        keep = cells > cells[0]
                        keep[0] = True
                        listed[r] = cells[keep]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in listed])]).astype(np.int32)
            cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(listed) if listed else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], [*batch.schema.names, "cells"])

    return classes.mapInArrow(run, T.StructType([*classes.schema.fields, T.StructField("cells", T.ArrayType(T.LongType()))]))


def _compared(placed: DataFrame, least: float) -> DataFrame:
    """(cid, other, links): per block partial sums of linked vectors, and edges that span its components."""
    place = ["label", "dim", "cell"]
    at = lambda *more: placed.select("label", "dim", *more, F.posexplode("cells").alias("pos", "cell"))
    home = F.col("pos") == 0
    # Only numbers are summed here; cells that fit in a block need no more than to be met in.
    sizes = at().groupBy(*place).agg(F.count(F.when(home, 1)).alias("live"), F.count(F.when(~home, 1)).alias("came"))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    hot = written(sizes.where((F.col("live") > BLOCK) | (F.col("came") > BLOCK)).select(*place, blocks("live").alias("nr"), blocks("came").alias("nv")), "hot")
    small = hot.count() * 64 <= 8 << 20
    rows = at("cid", "n", "v").withColumn("home", home).join(F.broadcast(hot) if small else hot, place, "left")
    rows = rows.withColumns({"nr": F.coalesce("nr", F.lit(1)), "nv": F.coalesce("nv", F.lit(1))})
    mine = F.pmod(F.xxhash64("cid", F.lit(3)), F.when(F.col("home"), F.col("nr")).otherwise(F.col("nv"))).cast("int")
    rows = rows.withColumn("mine", mine)
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    # A cell of one block is one meeting; else blocks of residents meet each other and those of visitors.
    single = (F.col("nr") == 1) & (F.col("nv") == 1)
    among = F.transform(upto("nr"), lambda b: F.struct(F.lit(0).alias("kind"), F.least("mine", b).alias("p"), F.greatest("mine", b).alias("q")))
    against = F.transform(upto("nv"), lambda b: F.struct(F.lit(1).alias("kind"), b.alias("p"), F.col("mine").alias("q")))
    coming = F.transform(upto("nr"), lambda b: F.struct(F.lit(1).alias("kind"), F.col("mine").alias("p"), b.alias("q")))
    one = F.array(F.struct(F.lit(2).alias("kind"), F.lit(0).alias("p"), F.lit(0).alias("q")))
    rows = rows.withColumn("k", F.explode(F.when(single, one).when(F.col("home"), F.concat(among, against)).otherwise(coming)))
    # Side 0 is compared with side 1, and side 2 with itself, each pair once; in a single meeting residents (2) are also compared with visitors (0).
    side = F.when(F.col("k.kind") == 2, F.when(F.col("home"), 2).otherwise(0)).when(F.col("k.kind") == 1, F.when(F.col("home"), 1).otherwise(0))
    side = side.when(F.col("k.p") == F.col("k.q"), 2).when(F.col("mine") == F.col("k.p"), 0).otherwise(1)
    rows = rows.select(F.xxhash64(*place, "k.kind", "k.p", "k.q").alias("key"), side.alias("side"), "cid", "n", "v")
    rows = rows.repartition(partitions(placed.sparkSession), "key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = column(batch, "key").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])).tolist() + [len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if held and column(held[0], "key")[0].as_py() != key[a]:
                    yield from _block(held, least)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield from _block(held, least)

    return rows.mapInArrow(run, "cid long, other long, links long")


def _block(parts: list[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    side, cid, n = (column(rows, c).to_numpy() for c in ("side", "cid", "n"))
    x = _unit(column(rows, "v").flatten().to_numpy().reshape(len(cid), -1))
    residents = np.flatnonzero(side == 2)
    meets = [(residents, residents), (np.flatnonzero(side == 0), np.flatnonzero(side != 0))]
    links = np.zeros(len(cid), np.int64)
    comp = np.arange(len(cid))
    edges: list[tuple[int, int]] = []
    for k, (a, b) in enumerate(meets):
        if not len(a) or not len(b):
            continue
        y = x[b]
        for lo in range(0, len(a), 256):
            some = a[lo : lo + 256]
            near = x[some] @ y.T >= least
            if k == 0:
                near &= some[:, None] < b[None, :]
            hit = np.flatnonzero(near.any(axis=1))
            if not len(hit):
                continue
            links[some[hit]] += near[hit] @ n[b]
            links[b] += n[some[hit]] @ near[hit]
            for r in hit.tolist():
                found = b[near[r]]
                other = found[comp[found] != comp[some[r]]]
                while len(other):
                    # Of every component met only one link is told.
                    edges.append((some[r], other[0]))
                    comp[comp == comp[other[0]]] = comp[some[r]]
                    other = other[comp[other] != comp[some[r]]]
    hit = np.flatnonzero(links)
    if len(hit):
        e = np.array(edges)
        ids = np.concatenate([cid[hit], cid[e[:, 0]]])
        other = pa.array(np.concatenate([np.zeros(len(hit), np.int64), cid[e[:, 1]]]), mask=np.arange(len(ids)) < len(hit))
        yield pa.RecordBatch.from_arrays([pa.array(ids), other, pa.array(np.concatenate([links[hit], np.zeros(len(e), np.int64)]))], ["cid", "other", "links"])


def _grids(usable: DataFrame, least: float) -> dict[int, Grid]:
    """A grid for each length of which one label has more than PER_CELL vectors, from a bounded sample."""
    per_label = usable.groupBy("dim", "label").agg(F.count("*").alias("n"))
    # One row per length.  A vector's label has sum(n * n) / sum(n) vectors on average.
    dims = per_label.groupBy("dim").agg(F.sum("n").alias("rows"), F.max("n").alias("most"), (F.sum(F.col("n").cast("double") * F.col("n")) / F.sum("n")).alias("per")).where(F.col("most") > PER_CELL)
    grids = {}
    for dim, rows, _, per in sorted(map(tuple, dims.collect())):
        # Hashes of values choose, so copies are chosen together and then dropped.
        share = max(1, int((1 << 20) * min(1.0, 4 * SAMPLE_ROWS / rows)))
        some = usable.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < share)).select("v").distinct()
        got = some.orderBy(F.xxhash64("v", F.lit(1)), "v").limit(SAMPLE_ROWS).toArrow().column("v").combine_chunks()
        if len(got):
            grids[dim] = fit(_unit(got.flatten().to_numpy().reshape(-1, dim)), per, least)
    return grids


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = LEAST) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector.

    Vectors with a null label, that are null, empty or zero, or that hold a null or non-finite
    component link with nothing; nor do vectors of different lengths.  Equal vectors form one class,
    all linked with each other; repeated rows count as others.  Null ids name no component unless
    alone.  Other columns are not read.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    v = F.col(vector_col)
    good = F.coalesce(F.col(label_col).isNotNull() & (F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("label"), F.transform(v, lambda x: x + F.lit(0)).alias("v"), good.alias("good"))
    # Two hashes name a class further on, so that values move no more than they must.
    usable = rows.where("good").withColumns({"dim": F.size("v"), "h1": F.xxhash64("v", F.lit(11)), "h2": F.xxhash64(F.lit(12), "v")})
    grids = _grids(usable, least)
    classes = usable.groupBy("label", "dim", "v").agg(F.count("*").alias("n"), F.min("_id").alias("least"), F.first("h1").alias("h1"), F.first("h2").alias("h2"))
    placed = written(_placed(classes.withColumn("cid", F.monotonically_increasing_id()), grids), "classes")
    found = written(_compared(placed, least), "compared")
    links = found.where("other IS NULL").groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(found.where("other IS NOT NULL"), "cid", "other")
    named = placed.select("cid", "label", "dim", "h1", "h2", "n", "least").join(links, "cid", "left").join(groups, F.col("cid") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "cid"))
    names = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    key = ["label", "dim", "h1", "h2"]
    named = named.join(names, "comp").select(*key, (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    done = usable.select(*key, "_id").join(named, key).select("_id", "n_links", "component_id")
    rest = rows.where("not good").select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    return done.union(rest).select(F.col("_id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), "component_id", F.coalesce(F.col("_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op5: all vectors."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
