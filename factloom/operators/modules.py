"""Grouping files into modules, and path trees."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from . import graph, relational as R

INIT = "main|init|config|setup|start|begin"
SIZE_CAP = 131072


def by_directory(files: DataFrame, path: str, size: str) -> DataFrame:
    """(dir, n, size): files of each directory counted and summed."""
    return files.groupBy(X.dir_name(path).alias("dir")).agg(F.count("*").alias("n"), F.sum(size).alias("size")).orderBy("dir")


def capped_components(files: DataFrame, edges: DataFrame, cap: int = SIZE_CAP) -> DataFrame:
    """Size-capped components per directory (I3, A15): (dir, file, component, size).

    files: (dir, file, size); edges: (dir, src, dst).  The walk is depth first over sorted neighbours
    and takes a file only if the component stays within the cap; a larger file stands alone.  The walk
    is sequential by nature; its unit is one connected component, found first, so that a directory with
    many files is spread over tasks, and rows carry names and sizes only.
    """
    key = lambda c: F.concat_ws("\0", "dir", c)
    known = edges.join(files.select("dir", F.col("file").alias("src")), ["dir", "src"], "left_semi").join(files.select("dir", F.col("file").alias("dst")), ["dir", "dst"], "left_semi")
    part = graph.components(known.select(key("src").alias("src"), key("dst").alias("dst")), files.select(key("file").alias("v")))
    near = known.select("dir", F.col("src").alias("file"), F.col("dst").alias("n")).union(known.select("dir", "dst", "src")).groupBy("dir", "file").agg(F.array_sort(F.collect_set("n")).alias("near"))
    rows = files.select("dir", "file", "size").join(near, ["dir", "file"], "left").withColumn("v", key("file")).join(part, "v").drop("v")

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("file", kind="stable")
        near = {f: list(n) if n is not None else [] for f, n in zip(group.file, group.near)}
        size = dict(zip(group.file, group["size"].fillna(0)))
        where: dict[str, str] = {}
        for start in group.file:
            if start in where:
                continue
            total, where[start], stack = size[start], start, [iter(near[start])]
            while stack:
                for f in stack[-1]:
                    if f not in where and total + size[f] <= cap:
                        where[f] = start
                        total += size[f]
                        stack.append(iter(near[f]))
                        break
                else:
                    stack.pop()
        return pd.DataFrame({"dir": group["dir"], "file": group.file, "component": group.file.map(where), "size": group["size"].astype("int64")})

    return rows.groupBy("component").applyInPandas(walk, "dir string, file string, component string, size long")


def assemble(files: DataFrame, functions: DataFrame, edges: DataFrame, cap: int = SIZE_CAP) -> tuple[DataFrame, DataFrame]:
    """Modules and their dependencies.

    files: (file, size); functions: (file, name); edges: (src, dst) between files, calls and includes.
    Returns (module, ord, file) and (module, dependency) without cycles.
    """
    files = files.withColumn("dir", X.dir_name("file"))
    with_code = functions.select("file").distinct()
    headers = F.col("file").rlike(r"\.(h|hpp)$")
    # Headers without functions belong to no module (P5).
    # Each step is used several times further on, so each is a table.
    functions = graph._cut(functions)
    kept = graph._cut(files.join(with_code.withColumn("_code", F.lit(True)), "file", "left").where(~headers | F.col("_code")).drop("_code"))
    init = R.any_of(functions, ["file"], F.lower("name").rlike(INIT), "init").where("init").select("file")
    edges = graph._cut(edges.where("src <> dst").select("src", "dst").distinct())
    place = lambda c: F.struct(X.dir_name(c).alias("d"))
    founders = kept.join(init, "file", "left_semi").select(F.col("file").alias("founder"), X.stem("file").alias("module"))
    direct = founders.join(edges, F.col("founder") == F.col("src")).where(place("src") == place("dst")).select("module", "founder", F.col("dst").alias("file"))
    direct = direct.join(founders.select(F.col("founder").alias("file")), "file", "left_anti").join(kept.select("file"), "file", "left_semi")
    direct = R.first_by(direct, ["file"], ["founder"])
    first = graph._cut(founders.select("module", F.col("founder").alias("file")).union(direct.select("module", "file")))
    rest = kept.join(first.select("file"), "file", "left_anti")
    inside = edges.join(rest.select(F.col("file").alias("src"), "dir"), "src").join(rest.select(F.col("file").alias("dst"), F.col("dir").alias("dir2")), "dst").where("dir = dir2").select("dir", "src", "dst")
    packed = graph._cut(capped_components(graph._cut(rest.select("dir", "file", "size")), graph._cut(inside), cap))
    stems = packed.withColumn("stem", X.stem("file"))
    named = stems.groupBy("dir", "component").agg(F.count("*").alias("n"), F.min("stem").alias("only")).join(R.common_prefix(stems, ["dir", "component"], "stem"), ["dir", "component"])
    order = Window.partitionBy("dir").orderBy("component")
    named = named.withColumn("i", F.row_number().over(order)).withColumn("parts", F.count("*").over(Window.partitionBy("dir")))
    prefix = F.regexp_replace("prefix", "_$", "")
    by_dir = F.when(F.col("parts") > 1, F.concat(X.base_name("dir"), F.lit("_"), "i")).otherwise(X.base_name("dir"))
    named = named.select("dir", "component", F.when(F.col("n") == 1, F.col("only")).when(F.char_length("prefix") > 2, prefix).otherwise(F.when(F.col("dir") == "", F.lit("root")).otherwise(by_dir)).alias("module"))
    members = graph._cut(first.select("module", "file", X.dir_name("file").alias("dir")).union(packed.join(named, ["dir", "component"]).select("module", "file", "dir")))
    # Equal names in different directories are told apart by the directory.
    clash = members.groupBy("module").agg((F.count_distinct("dir") > 1).alias("clash"))
    members = members.join(clash, "module").select(F.when(F.col("clash"), F.concat("dir", F.lit("/"), "module")).otherwise(F.col("module")).alias("module"), "file")
    modules = graph._cut(members.withColumn("ord", F.row_number().over(Window.partitionBy("module").orderBy("file"))).select("module", "ord", "file"))
    rolled = R.group_edges(edges, modules, "src", "dst", "file", "module")
    spark = files.sparkSession
    main = functions.where("name = 'main'").join(modules, "file").orderBy("file").select("module").limit(1)
    # One row per pair of modules: the size of the module graph, not of the code.
    kept_edges = graph.without_cycles([tuple(r) for r in rolled.collect()], [r[0] for r in main.collect()])
    return modules, spark.createDataFrame(kept_edges, "module string, dependency string")


def path_tree(paths: DataFrame, path: str, most_depth: int | None = None) -> DataFrame:
    """All prefixes of paths (S22, L6): (path, depth, name, parent), each once."""
    parts = F.split(path, "/", -1)
    depth = F.size(parts) if most_depth is None else F.least(F.size(parts), F.lit(most_depth))
    rows = paths.select(parts.alias("p"), F.explode(F.sequence(F.lit(1), depth)).alias("depth"))
    join = lambda n: F.array_join(F.slice("p", F.lit(1), n), "/")
    return rows.select(join(F.col("depth")).alias("path"), "depth", F.get("p", F.col("depth") - 1).alias("name"), F.when(F.col("depth") > 1, join(F.col("depth") - 1)).alias("parent")).distinct()


def tree_text(tree: DataFrame) -> DataFrame:
    """Rendered tree (I5, K4): (path, line) in depth-first order, connectors by last child."""
    last = F.row_number().over(Window.partitionBy("parent").orderBy(F.desc("name"))) == 1
    flagged = tree.withColumn("last", last)
    above = flagged.select(F.col("path").alias("a_path"), F.col("depth").alias("a_depth"), F.col("last").alias("a_last"))
    parts = F.split("path", "/", -1)
    ancestors = F.transform(F.sequence(F.lit(1), F.col("depth") - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    rows = flagged.withColumn("a_path", F.explode_outer(F.when(F.col("depth") > 1, ancestors)))
    bars = rows.join(above, "a_path", "left").groupBy("path", "depth", "name", "last").agg(F.array_sort(F.collect_list(F.when(F.col("a_path").isNotNull(), F.struct("a_depth", "a_last")))).alias("bars"))
    prefix = F.array_join(F.transform("bars", lambda b: F.when(b["a_last"], "    ").otherwise("│   ")), "")
    return bars.select("path", F.concat(prefix, F.when(F.col("last"), "└── ").otherwise("├── "), "name").alias("line")).orderBy(F.split("path", "/", -1))
