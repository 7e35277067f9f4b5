"""Writers of facts, trees, prompts and documents; what goes to one file is one group's worth."""

from __future__ import annotations

import json
import logging
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import text as X
from .operators import graph, modules, relational as R

log = logging.getLogger("factloom")


def logger(level: int = logging.INFO, path: str | None = None) -> logging.Logger:
    """Messages to the console, and all of them to a file if asked for."""
    log.setLevel(logging.DEBUG)
    if not log.handlers:
        console = logging.StreamHandler()
        console.setLevel(level)
        log.addHandler(console)
    if path:
        log.addHandler(logging.FileHandler(path, encoding="utf-8"))
    return log


def facts_table(df: DataFrame, path: str) -> None:
    """Parquet is the store (K1, K3, K5-K8); JSON below is for export."""
    df.write.mode("overwrite").parquet(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def call_graph_records(edges: DataFrame, functions: DataFrame) -> DataFrame:
    """(key, callees): every function with its sorted callees, unknown ones as ``unknown:<name>`` (K1)."""
    calls = edges.select(X.key("caller_file", "caller").alias("key"), F.when(F.col("callee_file").isNull(), F.concat(F.lit("unknown:"), "callee")).otherwise(X.key("callee_file", "callee")).alias("callee"))
    return R.with_uses(functions.select(X.key("file", "name").alias("key")).distinct(), calls, "key", "callee", "callees")


def file_records(functions: DataFrame, includes: DataFrame, files: DataFrame) -> DataFrame:
    """(file, functions, includes) with only the exported columns (K3, P17); one key keeps its customary spelling."""
    f = functions.groupBy("file").agg(F.array_sort(F.collect_set(F.struct("start_line", "name", F.col("defined_in").alias("definded_in"), "end_line"))).alias("functions"))
    i = includes.groupBy("file").agg(F.array_sort(F.collect_set("included")).alias("includes"))
    return files.select("file").join(f, "file", "left").join(i, "file", "left")


def type_records(types: DataFrame, fields: DataFrame, values: DataFrame, uses: DataFrame) -> DataFrame:
    """Types with fields or values and their users."""
    f = fields.groupBy("type_name", "defined_in").agg(F.array_sort(F.collect_list(F.struct("parent_path", "ordinal", "name", "type_text", "nested_kind"))).alias("fields"))
    v = values.groupBy("type_name", "defined_in").agg(F.array_sort(F.collect_list(F.struct("ordinal", "name", "value"))).alias("values"))
    rows = types.withColumn("type_name", F.col("name")).join(f, ["type_name", "defined_in"], "left").join(v, ["type_name", "defined_in"], "left").drop("type_name")
    users = uses.select("name", X.key("use_file", "use_function").alias("use"))
    return R.with_uses(rows, users, "name", "use", "used_by")


def used_records(facts: DataFrame, uses: DataFrame) -> DataFrame:
    """Macros or globals with their users (K6, K7)."""
    return R.with_uses(facts, uses.select("name", X.key("use_file", "use_function").alias("use")), "name", "use", "used_in")


def module_records(members: DataFrame, dependencies: DataFrame) -> DataFrame:
    """(module, files, dependencies) (K8, K9)."""
    files = members.groupBy("module").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "file"))), lambda x: x["file"]).alias("files"))
    return R.with_uses(files, dependencies, "module", "dependency", "dependencies").orderBy("module")


def call_tree(edges: DataFrame, start: DataFrame, path: str, most_depth: int | None = None) -> None:
    """Call paths as indented text (K2): parts in order, sorted by range, so none is one task's."""
    graph.tree_text(graph.call_paths(edges, start, most_depth)).select("line").write.mode("overwrite").text(path)


def file_tree(paths: DataFrame, path: str) -> None:
    """A drawn tree (K4)."""
    modules.tree_text(modules.path_tree(paths, "path")).select("line").coalesce(1).write.mode("overwrite").text(path)


def tree_json(paths: list[str]) -> str:
    """Nested objects of a listing."""
    root: dict = {}
    for p in sorted(paths):
        node = root
        for part in p.split("/"):
            node = node.setdefault(part, {})
    return json.dumps(root, ensure_ascii=False, indent=2)


def text_files(df: DataFrame, root: str, path: str, text: str) -> int:
    """One file per row below a mounted folder (K10, K11); whole files appear at once, existing ones stay."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            written = 0
            for name, body in zip(batch["_p"], batch["_t"]):
                full = os.path.join(root, name)
                if body is None or os.path.exists(full):
                    continue
                os.makedirs(os.path.dirname(full) or ".", exist_ok=True)
                temporary = f"{full}.{os.getpid()}"
                with open(temporary, "w", encoding="utf-8", errors="surrogatepass") as f:
                    f.write(body)
                os.replace(temporary, full)
                written += 1
            yield pd.DataFrame({"n": [written]})

    return df.select(F.col(path).alias("_p"), F.col(text).alias("_t")).mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
