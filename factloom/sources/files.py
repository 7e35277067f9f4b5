"""Readers of projects: source files, project settings, startup files, JSON facts."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import relational as R

IGNORED_DIRS = (".git", ".svn", "build", "node_modules", "__pycache__", "Debug", "Release")
IGNORED_SUFFIXES = (".o", ".obj", ".exe", ".dll", ".so", ".a", ".lib", ".bin", ".hex", ".pyc", ".log")
STARTUP_DIRS = ("", "startup", "src", "core", "cmsis")
STARTUP_NAMES = ("startup.s", "startup.S", "startup_stm32.s", "startup_device.s", "crt0.s")


def source_files(spark: SparkSession, root: str, suffixes: Sequence[str] = ("c", "cpp", "cc", "h", "hpp")) -> DataFrame:
    """(path, text, size) below a folder, one row per file (S1, S4, S20, S23); order is the reader's to choose."""
    read = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.{" + ",".join(suffixes) + "}")
    base = os.path.abspath(root.removeprefix("file:")).rstrip("/") + "/"
    full = F.regexp_replace(F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")), r"^file:/+", "/")
    return read.select(F.when(F.startswith(full, F.lit(base)), F.substring(full, len(base) + 1, 1 << 20)).otherwise(full).alias("path"), F.col("value").alias("text"), F.col("_metadata.file_size").alias("size"))


def list_tree(spark: SparkSession, root: str, most_depth: int | None = None) -> DataFrame:
    """(path, is_dir) below a folder without ignored files and folders (S22, P9); empty folders are seen too."""
    rows = []
    for folder, dirs, files in os.walk(root):
        dirs[:] = sorted(d for d in dirs if d not in IGNORED_DIRS)
        here = os.path.relpath(folder, root)
        depth = 0 if here == "." else here.count(os.sep) + 1
        if most_depth is not None and depth >= most_depth:
            dirs[:] = []
            continue
        for name in sorted(dirs) + sorted(f for f in files if not f.lower().endswith(IGNORED_SUFFIXES)):
            rows.append((name if here == "." else f"{here}/{name}", name in dirs))
    return spark.createDataFrame(rows, "path string, is_dir boolean")


def read_facts(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> DataFrame:
    """JSON facts with a fixed schema (S11, S12, S25): malformed records are nulls, or an error if strict."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST" if strict else "PERMISSIVE")


def include_paths(projects: DataFrame) -> DataFrame:
    """(project, ord, dir) of project files (path, text): both kinds of XML.

    Distinct in order of first appearance; back slashes become slashes, relative paths start at the file.
    """
    keil = F.split(F.array_join(F.regexp_extract_all("text", F.lit(r"<IncludePath>([^<]*)</IncludePath>"), F.lit(1)), ";"), ";")
    block = F.array_join(F.regexp_extract_all("text", F.lit(r'(?s)superClass="gnu\.c\.compiler\.option\.include\.paths"(.*?)</option>'), F.lit(1)), "")
    cdt = F.regexp_extract_all(block, F.lit(r'<listOptionValue[^>]*\bvalue="([^"]*)"'), F.lit(1))
    cdt = F.transform(cdt, lambda v: _workspace(F.replace(v, F.lit("&quot;"), F.lit(""))))
    base = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", r"/[^/]*$", "/")).otherwise(F.lit(""))
    raw = F.transform(F.filter(F.transform(F.concat(keil, cdt), lambda v: F.trim(v)), lambda v: v != ""), lambda v: F.replace(v, F.lit("\\"), F.lit("/")))
    full = F.transform(F.array_distinct(raw), lambda v: F.when(v.rlike(r"^(/|[A-Za-z]:)"), v).otherwise(F.concat(base, v)))
    return projects.select(F.col("path").alias("project"), F.posexplode(F.array_distinct(full)).alias("ord", "dir"))


def _workspace(v):
    inner = F.regexp_extract(v, r"^\$\{workspace_loc:/?(.*)\}$", 1)
    return F.when(F.startswith(v, F.lit("${workspace_loc:")), F.regexp_replace(inner, r"^\$\{ProjName\}/?", "")).otherwise(v)


def project_defines(projects: DataFrame) -> DataFrame:
    """(name, value) of project files (S8, S9): a bare name has value 1, the last definition wins."""
    keil = F.split(F.array_join(F.regexp_extract_all("text", F.lit(r"<Define>([^<]*)</Define>"), F.lit(1)), ";"), "[;,]")
    block = F.array_join(F.regexp_extract_all("text", F.lit(r'(?s)superClass="gnu\.c\.compiler\.option\.preprocessor\.def\.symbols"(.*?)</option>'), F.lit(1)), "")
    cdt = F.regexp_extract_all(block, F.lit(r'<listOptionValue[^>]*\bvalue="([^"]*)"'), F.lit(1))
    rows = projects.select("path", F.posexplode(F.concat(keil, cdt)).alias("ord", "d")).withColumn("d", F.trim("d")).where("d <> ''")
    name = F.trim(F.split_part("d", F.lit("="), F.lit(1)))
    value = F.when(F.instr("d", "=") > 0, F.trim(F.expr("substr(d, instr(d, '=') + 1)"))).otherwise(F.lit("1"))
    return R.last_wins(rows.select("path", "ord", name.alias("name"), value.alias("value")), ["name"], ["path", "ord", "value"], ["value"])


def compiler_arguments(root: str, includes: Sequence[str], defines: dict[str, str]) -> list[str]:
    """S10."""
    fixed = [root, *(f"{root}/{d}" for d in ("include", "inc", "src", "Core/Inc"))]
    return [f"-I{d}" for d in dict.fromkeys([*fixed, *includes])] + [f"-D{k}={v}" for k, v in defines.items()]


def startup_candidates(files: DataFrame) -> DataFrame:
    """Ranked startup files (S17-S19): named by a build file, then well-known places, then by content."""
    config = files.where(F.lower("path").rlike(r"\.(uvprojx?|ewp)$|(^|/)makefile$|(^|/)cmakelists\.txt$"))
    order = F.when(F.lower("path").rlike(r"\.uvprojx$"), 0).when(F.lower("path").rlike(r"\.uvproj$"), 1).when(F.lower("path").rlike(r"\.ewp$"), 2).when(F.lower("path").rlike("makefile$"), 3).otherwise(4)
    names = F.regexp_extract_all("text", F.lit(r"(?i)([\w./\\-]*startup[\w./\\-]*\.s)\b"), F.lit(1))
    base = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", r"/[^/]*$", "/")).otherwise(F.lit(""))
    named = config.select(F.lit(0).alias("rank"), order.alias("place"), F.explode(names).alias("n"), base.alias("base"))
    named = named.select("rank", "place", F.regexp_replace(F.concat("base", F.regexp_replace("n", r"\\", "/")), r"(^|/)\./", "$1").alias("path"))
    assembler = files.where(F.lower("path").rlike(r"\.s$"))
    places = [f"{d}/{n}" if d else n for d in STARTUP_DIRS for n in STARTUP_NAMES]
    known = assembler.where(F.col("path").isin(*places)).select(F.lit(1).alias("rank"), F.array_position(F.array(*[F.lit(p) for p in places]), F.col("path")).cast("int").alias("place"), "path")
    content = assembler.where(F.col("text").rlike("Reset_Handler|Vector|__initial_sp")).select(F.lit(2).alias("rank"), F.lit(0).alias("place"), "path")
    return named.join(files.select("path"), "path", "left_semi").select("rank", "place", "path").union(known).union(content)


def startup_facts(startup: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vectors, exports and the entry of startup files (path, text)."""
    table = F.regexp_extract("text", r"(?s)__Vectors\b(.*?)(?:__Vectors_End|__Vectors_Size|\z)", 1)
    vectors = startup.select("path", F.posexplode(F.regexp_extract_all(table, F.lit(r"\bDCD\s+([A-Za-z_]\w*)"), F.lit(1))).alias("index", "handler"))
    line = F.regexp_extract_all("text", F.lit(r"(?m)^\s*EXPORT\s+(\w+(?:[ \t]*\[WEAK\])?)"), F.lit(1))
    exports = startup.select("path", F.explode(line).alias("e")).select("path", F.regexp_extract("e", r"^\w+", 0).alias("name"), F.contains("e", F.lit("[WEAK]")).alias("is_weak")).distinct()
    reset = F.nullif(F.regexp_extract("text", r"(?m)^\s*(Reset_Handler)\s+PROC", 1), F.lit(""))
    entry = startup.select("path", F.coalesce(reset, F.nullif(F.regexp_extract("text", r"(?m)^\s*(\w+)\s+PROC", 1), F.lit(""))).alias("entry"))
    return vectors, exports, entry
