"""Command line: ``python -m factloom.cli --mode analyze PROJECT --output OUT``."""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import functions as F

from . import sinks
from .operators import relational as R
from .plans import analyze as A
from .plans import prompts as P
from .session import local_session, ship

DOCS = {"f_doc": "function", "m_doc": "macro", "s_doc": "struct", "g_doc": "global_var", "doc": "module", "startup_doc": "startup"}
TRAIN = {f"{k}_train": k for k in ("function", "macro", "struct", "global_var", "module", "startup")}


def config(path: str | None) -> dict:
    """Settings with the key from the environment; a missing file means prompts only."""
    found = {"ignore_dirs": [], "max_concurrency": 5}
    if path and os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            found |= json.load(f)
    if os.environ.get("FACTLOOM_API_KEY"):
        found["api_key"] = os.environ["FACTLOOM_API_KEY"]
    return found


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser()
    p.add_argument("project")
    p.add_argument("--mode", default="analyze", choices=["analyze", "split", "startup", *DOCS, *TRAIN])
    p.add_argument("--output", default="output")
    p.add_argument("--config")
    p.add_argument("--depth", type=int, help="longest call paths in the call tree; all, if not given")
    for name in ("function", "macro", "struct", "var", "module"):
        p.add_argument(f"--{name}")
    a = p.parse_args(argv)
    settings, log = config(a.config), sinks.logger()
    ask = P.completer(settings)
    spark = local_session()
    ship(spark)
    files, startup, includes, defines = A.read_project(spark, a.project)
    files = R.ignore_paths(files, "path", settings["ignore_dirs"])
    f = A.facts(files, startup, includes, defines)
    out = lambda name: os.path.join(a.output, name)
    for row in A.progress(f).collect():
        log.info("%d %s", row["n"], row["kind"])
    lost = A.missing_includes(files, includes)
    for row in lost.limit(20).collect():  # the first ones are shown, all are written
        log.warning("%s includes %s, which is nowhere", row["file"], row["wanted"])
    if a.mode in ("analyze", "startup"):
        if startup is not None:
            for name, table in zip(("startup_vectors", "startup_exports", "startup_entry"), A.S.startup_facts(startup)):
                sinks.json_lines(table, out(name))
    if a.mode == "analyze":
        sinks.json_lines(sinks.call_graph_records(f.edges, f.functions), out("call_graph"))
        sinks.json_lines(sinks.file_records(f.functions, f.includes, f.files), out("file_info"))
        sinks.json_lines(sinks.type_records(f.types, f.fields, f.enum_values, f.type_uses), out("struct_info"))
        sinks.json_lines(sinks.used_records(f.macros, f.macro_uses), out("macro_info"))
        sinks.json_lines(sinks.used_records(f.globals_, f.global_uses), out("global_var_info"))
        sinks.json_lines(lost, out("missing_includes"))
        sinks.file_tree(files.select("path"), out("project_tree"))
        e = f.edges.where("callee_file IS NOT NULL").select(A.X.key("caller_file", "caller").alias("src"), A.X.key("callee_file", "callee").alias("dst"))
        sinks.call_tree(e, A.graph.roots(e, f.functions.select(A.X.key("file", "name").alias("v"))), out("call_tree"), a.depth)
    if a.mode in ("analyze", "split"):
        sinks.json_lines(sinks.module_records(*A.module_tables(f)), out("module_structure"))
    if a.mode in DOCS:
        kind = DOCS[a.mode]
        if kind in ("function", "module"):
            done = (A.document_functions if kind == "function" else A.document_modules)(f, files, ask, settings["max_concurrency"])
        else:
            made = A.startup_prompt(f, files) if kind == "startup" else A.entity_prompts(f, files, kind)
            done = P.document(made, None, ask, settings["max_concurrency"])
        key = a.function or a.macro or a.struct or a.var or a.module
        done = done.where(F.col("entity_key") == key) if key else done
        done.write.mode("overwrite").parquet(out(f"docs_{kind}"))
        log.info("%d prompts", sinks.text_files(done.withColumn("p", F.concat("path", F.lit("_prompt.txt"))), a.output, "p", "prompt"))
        sinks.text_files(done.withColumn("p", F.concat("path", F.lit("_doc.md"))), a.output, "p", "response")
    if a.mode in TRAIN:
        kind = TRAIN[a.mode]
        docs = spark.read.parquet(out(f"docs_{kind}"))
        made = P.train_prompts(docs, A.bodies(f, files).select(F.lit("function").alias("entity_kind"), A.X.key("file", "name").alias("entity_key"), "source"))
        done = P.document(made, None, ask, settings["max_concurrency"] + 2)
        done.write.mode("overwrite").parquet(out(f"train_{kind}"))
        sinks.text_files(done.withColumn("p", F.concat("path", F.lit("_train.md"))), a.output, "p", "response")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
