"""From a C source tree to fact tables, graphs, modules and prompts."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import graph, lines as L, modules, relational as R
from ..sources import cparse, files as S
from . import prompts as P


class Facts(NamedTuple):
    files: DataFrame
    functions: DataFrame
    calls: DataFrame
    edges: DataFrame
    includes: DataFrame
    types: DataFrame
    fields: DataFrame
    enum_values: DataFrame
    type_uses: DataFrame
    typedefs: DataFrame
    macros: DataFrame
    macro_uses: DataFrame
    globals_: DataFrame
    global_uses: DataFrame


BUILTIN_PREFIXES = ("__STDC", "__GNUC", "__GNU", "__clang", "__INT", "__UINT", "__FLT", "__DBL", "__LDBL", "__SIZEOF", "__ATOMIC", "__CHAR", "__BYTE_ORDER", "__ORDER", "__OPTIMIZE", "__VERSION", "__ELF", "__x86", "__amd64", "__ARM", "__arm", "__SSE", "__MMX", "__USER_LABEL", "__REGISTER", "__PTRDIFF", "__WCHAR", "__WINT", "__SIG_ATOMIC", "__BIGGEST", "__OBJC", "__DATE__", "__TIME__", "__FILE__", "__LINE__")
BUILTIN_NAMES = ("linux", "unix", "i386")
#: Headers of the language's own library.
LIBRARY_HEADERS = tuple(f"{x}.h" for x in "assert complex ctype errno fenv float inttypes iso646 limits locale math setjmp signal stdalign stdarg stdatomic stdbool stddef stdint stdio stdlib stdnoreturn string tgmath threads time uchar wchar wctype".split())


def include_targets(files: DataFrame, includes_at: DataFrame | None = None) -> DataFrame:
    """(file, wanted, found): every include's header, null for those that no folder has.

    The including file's folder comes first, then the project's in their order.
    """
    wanted = files.select(F.col("path").alias("file"), F.explode(X.all_matches("text", X.INCLUDE_NAMES)).alias("wanted")).distinct()
    base = F.when(F.instr("file", "/") > 0, F.concat(X.dir_name("file"), F.lit("/"))).otherwise(F.lit(""))
    tries = wanted.select("file", "wanted", F.lit(0).alias("rank"), F.concat(base, "wanted").alias("at"))
    if includes_at is not None:
        # Each include tries every directory of its project, which people listed by hand.
        dirs = includes_at.agg(F.collect_list(F.struct("ord", "dir")).alias("dirs"))
        more = wanted.join(dirs).select("file", "wanted", F.explode("dirs").alias("d"))
        tries = tries.union(more.select("file", "wanted", F.col("d.ord") + 1, F.concat("d.dir", F.lit("/"), "wanted")))
    tries = tries.withColumn("at", X.normal_path("at"))
    hits = tries.join(files.select(F.col("path").alias("at")), "at")
    return R.ranked_probe(wanted, hits.withColumnRenamed("at", "found"), ["file", "wanted"], "rank", "found")


def missing_includes(files: DataFrame, includes_at: DataFrame | None = None) -> DataFrame:
    """(file, wanted) of includes that no file answers, the C library's headers aside."""
    lost = include_targets(files, includes_at).where("found IS NULL")
    return lost.where(~F.col("wanted").isin(*LIBRARY_HEADERS)).select("file", "wanted")


def progress(f: Facts) -> DataFrame:
    """(kind, n): how many entities each stage will meet."""
    counted = {"functions": f.functions, "macros": f.macros, "types": f.types, "globals": f.globals_, "files": f.files, "calls": f.edges}
    out = None
    for kind, table in counted.items():
        one = table.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = one if out is None else out.union(one)
    return out


def facts(files: DataFrame, startup: DataFrame | None = None, includes_at: DataFrame | None = None, defines: Mapping[str, str] = {}) -> Facts:
    """All fact tables of files (path, text, size); the parse is read many times, so it is stored once."""
    at = graph._cut(include_targets(files, includes_at))
    raw = graph._cut(cparse.facts(files, defines=defines, includes=at))
    of = lambda kind: raw.where(F.col("kind") == kind)
    functions = of("function").select("file", "name", F.col("file").alias("defined_in"), "start_line", "end_line").dropDuplicates(["file", "name", "start_line"])
    calls = of("call").select("file", F.col("owner").alias("caller"), F.col("name").alias("callee"), "ord")
    macros = R.priority_wins(of("macro").withColumn("line", F.col("start_line")), ["name", "file"], F.startswith(F.col("file"), F.lit("include/")), ["ord"], ["extra", "value", "line"])
    macros = R.drop_prefixed(macros, "name", BUILTIN_PREFIXES, BUILTIN_NAMES).select("name", F.col("extra").alias("params"), F.col("value").alias("content"), F.col("file").alias("defined_in"), "line")
    # A macro that is called looks like a function; it isn't one.
    real = calls.join(macros.select(F.col("name").alias("callee")).distinct(), "callee", "left_anti")
    if startup is not None:
        vectors, exports, entry = S.startup_facts(startup)
        added = R.weak_override(functions, exports.select("name", "is_weak", "path"), "name", "is_weak")
        missing = added.select(F.col("path").alias("file"), "name").union(entry.where("entry IS NOT NULL").select("path", F.col("entry").alias("name")))
        missing = missing.distinct().join(functions.select("file", "name"), ["file", "name"], "left_anti")
        functions = functions.union(missing.select("file", "name", F.col("file").alias("defined_in"), F.lit(-1), F.lit(-1)))
        body = F.regexp_extract_all("text", F.lit(r"(?m)(?:LDR\s+\w+\s*,\s*=|\bBL\s+)(\w+)"), F.lit(1))
        jumps = startup.select("path", F.posexplode(body).alias("ord", "callee")).join(entry.where("entry IS NOT NULL"), "path")
        callee = F.when(F.col("callee") == "__main", "main").otherwise(F.col("callee"))
        real = real.select("file", "caller", "callee", "ord").union(jumps.select(F.col("path").alias("file"), F.col("entry").alias("caller"), callee, "ord"))
    resolved = R.resolve(real.select("file", "caller", "callee").distinct().withColumn("_c", X.key("file", "caller")), functions.withColumn("_k", F.struct("file", "start_line", "name")), "_c", "callee", "file", "name", "file", "_k")
    edges = resolved.select(F.split_part("_c", F.lit(":"), F.lit(1)).alias("caller_file"), F.split_part("_c", F.lit(":"), F.lit(2)).alias("caller"), "target_file", "callee")
    edges = edges.withColumnRenamed("target_file", "callee_file").distinct()
    names = files.select(F.col("path").alias("file"), "size")
    wanted = of("include").select("file", F.col("name").alias("wanted"))
    includes = wanted.join(at, ["file", "wanted"], "left").select("file", F.coalesce("found", "wanted").alias("included")).distinct()
    types = of("type").select(F.col("value").alias("kind"), "name", F.col("file").alias("defined_in"), "start_line", "end_line").dropDuplicates(["kind", "name", "defined_in", "start_line"])
    split = lambda i: F.split_part("extra", F.lit("|"), F.lit(i))
    fields = of("field").select(F.col("owner").alias("type_name"), split(1).alias("parent_path"), F.col("end_line").alias("ordinal"), "name", F.col("value").alias("type_text"), F.nullif(split(2), F.lit("")).alias("nested_kind"), F.col("file").alias("defined_in"))
    values = of("enum_value").select(F.col("owner").alias("type_name"), F.col("ord").alias("ordinal"), "name", F.col("value").cast("long").alias("value"), F.col("file").alias("defined_in"))
    typedefs = of("typedef").select("file", F.col("name").alias("alias"), X.bare_type(F.regexp_replace("value", r"^(struct|union|enum)\s+", "")).alias("target"))
    uses = of("use").select("name", F.col("file").alias("use_file"), F.col("owner").alias("use_function"))
    tagged = of("type_use").select("name", F.col("file").alias("use_file"), F.col("owner").alias("use_function"))
    known = types.select("name").union(typedefs.select("alias")).distinct()
    type_uses = R.fold_aliases(tagged.union(uses.join(known, "name", "left_semi")), typedefs, types, "name", "alias", "target")
    every = of("global").select("name", F.col("value").alias("type_text"), F.col("file").alias("defined_in"), (F.col("extra") == "definition").alias("is_definition"), "ord", F.col("start_line").alias("line"), "end_line")
    globals_ = R.last_wins(R.definitions_only(every), ["name", "defined_in"], ["ord"], ["type_text", "is_definition", "line", "end_line"]).select("name", "type_text", "defined_in", "is_definition", "line", "end_line")
    semi = lambda t: uses.join(t.select("name").distinct(), "name", "left_semi").distinct()
    # Everything below reads these many times, so they are tables.
    functions, edges, includes, type_uses, macros, globals_ = map(graph._cut, (functions, edges, includes, type_uses, macros, globals_))
    return Facts(names, functions, real, edges, includes, types, fields, values, type_uses, typedefs, macros, semi(macros), globals_, semi(globals_))


def module_tables(f: Facts) -> tuple[DataFrame, DataFrame]:
    """Modules and dependencies of a fact set."""
    called = f.edges.where("callee_file IS NOT NULL").select(F.col("caller_file").alias("src"), F.col("callee_file").alias("dst"))
    return modules.assemble(f.files, f.functions.select("file", "name"), called.union(f.includes.select("file", "included")))


def function_levels(f: Facts) -> DataFrame:
    """(v, level) of ``file:name`` keys, unknown callees included."""
    e = f.edges.select(X.key("caller_file", "caller").alias("src"), F.when(F.col("callee_file").isNull(), F.concat(F.lit("unknown:"), "callee")).otherwise(X.key("callee_file", "callee")).alias("dst"))
    return graph.levels(e, f.functions.select(X.key("file", "name").alias("v")))


def bodies(f: Facts, files: DataFrame) -> DataFrame:
    """(file, name, source) of functions with the comments above them."""
    where = f.functions.where("start_line > 0").select("file", "name", "start_line", "end_line")
    lines = files.select(F.col("path").alias("file"), "text")
    return L.documented_slices(where, lines, "file", "text", "start_line", "end_line", "source").select("file", "name", "source")


def function_prompts(f: Facts, files: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """Prompts of all functions with callees, callers and what is known of the callees."""
    source = bodies(f, files).withColumn("key", X.key("file", "name"))
    edges = f.edges.select(X.key("caller_file", "caller").alias("src"), F.coalesce(X.key("callee_file", "callee"), F.concat(F.lit("unknown:"), "callee")).alias("dst"))
    callees = edges.groupBy(F.col("src").alias("key")).agg(F.to_json(F.array_sort(F.collect_set("dst"))).alias("callees"))
    callers = edges.groupBy(F.col("dst").alias("key")).agg(F.to_json(F.array_sort(F.collect_set("src"))).alias("callers"))
    rows = source.join(callees, "key", "left").join(callers, "key", "left")
    known = F.lit(None).cast("string").alias("known")
    if docs is not None:
        rows = rows.join(told(edges.withColumnRenamed("src", "key"), docs, "key", "dst", "### Function", "\n##"), "key", "left")
        known = F.col("known")
    path = F.concat(F.lit("functions/"), "file", F.lit("/"), "name")
    return P.render(rows, "function", "doc", F.col("key"), path, name=F.col("name"), source=F.col("source"), callees=F.col("callees"), callee_docs=known, callers=F.col("callers"))


def document_functions(f: Facts, files: DataFrame, completer: P.Completer, workers: int | None = None) -> DataFrame:
    """Level by level (I11): callees are documented before their callers."""
    return _by_level(graph._cut(function_levels(f)), lambda done: function_prompts(f, files, done), completer, workers)


def user_samples(uses: DataFrame, source: DataFrame, k: int = 10) -> DataFrame:
    """(name, examples): sources of at most k users by a seeded hash."""
    rows = R.sample_k(uses.withColumn("_use", X.key("use_file", "use_function")), ["name"], "_use", k)
    rows = rows.join(source.select(F.col("file").alias("use_file"), F.col("name").alias("use_function"), "source"), ["use_file", "use_function"])
    return rows.groupBy("name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_use", "source"))), lambda x: F.concat(x["_use"], F.lit("\n"), x["source"])), "\n\n").alias("examples"), F.array_sort(F.collect_set("_use")).alias("users"))


def in_functions(uses: DataFrame) -> DataFrame:
    """Uses whose place is a function, not the file's outermost scope."""
    return uses.where(F.col("use_function") != "global")


def entity_prompts(f: Facts, files: DataFrame, kind: str) -> DataFrame:
    """Prompts of types, globals or macros (U4, U6, U7); uses at file scope name no function, so they are left out."""
    source = bodies(f, files)
    held = files.select(F.col("path").alias("defined_in"), "text")
    cut = lambda rows, a, b, out: L.documented_slices(rows, held, "defined_in", "text", a, b, out)
    if kind == "struct":
        uses = R.typed_uses(f.type_uses, f.globals_, f.global_uses, "name", "type_text", ["use_file", "use_function"])
        rows = cut(f.types, "start_line", "end_line", "definition").withColumn("facts", F.to_json(F.struct("kind", "name", "start_line", "end_line")))
    elif kind == "global_var":
        uses = f.global_uses
        rows = cut(f.globals_, "line", "end_line", "definition").withColumn("facts", F.to_json(F.struct("name", "type_text", "defined_in")))
    elif kind == "macro":
        uses = f.macro_uses
        around = f.macros.join(held, "defined_in", "left").withColumn("context", L.slice_lines(F.col("text"), F.col("line") - 20, F.col("line") + 100)).drop("text")
        rows = around.withColumn("definition", X.macro_text("name", "params", "content")).withColumn("facts", F.lit(""))
    else:
        raise ValueError(kind)
    uses = in_functions(uses)
    rows = rows.join(user_samples(uses, source, 5 if kind == "macro" else 10), "name", "left")
    path = F.concat(F.lit(f"{kind}s/"), X.stem("defined_in"), F.lit("/"), X.file_safe("name"))
    values = {"name": F.col("name"), "file": F.col("defined_in"), "definition": F.col("definition"), "facts": F.col("facts"), "users": X.bullets(F.coalesce("users", F.array().cast("array<string>"))), "examples": F.col("examples")}
    if kind == "macro":
        values["context"] = F.col("context")
    return P.render(rows, kind, "doc", X.key("defined_in", "name"), path, **values)


def module_prompts(f: Facts, files: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """Prompts of modules with all their sources and what is known of the modules they depend on."""
    members, deps = module_tables(f)
    return _module_prompts(members, deps, files, docs)


def _module_prompts(members: DataFrame, deps: DataFrame, files: DataFrame, docs: DataFrame | None) -> DataFrame:
    body = members.join(files.select(F.col("path").alias("file"), "text"), "file", "left").where("text IS NULL OR text <> ''")
    piece = F.concat(F.lit("// "), "file", F.lit("\n"), F.coalesce("text", F.lit("(not found)")))
    rows = L.concatenated(body, ["module"], ["ord"], piece, "\n\n", "source").join(body.groupBy("module").agg(F.to_json(F.array_sort(F.collect_list("file"))).alias("facts")), "module")
    rows = R.with_uses(rows, deps, "module", "dependency", "dependencies")
    known = F.lit(None).cast("string")
    if docs is not None:
        rows = rows.join(told(deps, docs, "module", "dependency"), "module", "left")
        known = F.col("known")
    return P.render(rows, "module", "doc", F.col("module"), F.concat(F.lit("modules/"), "module"), name=F.col("module"), facts=F.col("facts"), dependencies=X.bullets("dependencies"), dependency_docs=known, source=F.col("source"))


def told(edges: DataFrame, docs: DataFrame, src: str, dst: str, heading: str = "### Duties", stop: str = "\n### ") -> DataFrame:
    """(src, known): a section of the documents of all that a vertex points at, in order."""
    found = docs.select(F.col("entity_key").alias(dst), X.section("response", heading, stop).alias("_d"))
    piece = F.concat(F.col(dst), F.lit(": "), F.col("_d"))
    return L.concatenated(edges.select(src, dst).distinct().join(found, dst), [src], [dst], piece, "\n", "known")


def document_modules(f: Facts, files: DataFrame, completer: P.Completer, workers: int | None = None) -> DataFrame:
    """Level by level (I2, I11): modules are documented after those they depend on."""
    members, deps = (graph._cut(x) for x in module_tables(f))
    levels = graph._cut(graph.levels(deps.select(F.col("module").alias("src"), F.col("dependency").alias("dst")), members.select(F.col("module").alias("v"))))
    return _by_level(levels, lambda done: _module_prompts(members, deps, files, done), completer, workers)


def _by_level(levels: DataFrame, prompts, completer: P.Completer, workers: int | None) -> DataFrame:
    last = levels.agg(F.max("level")).first()[0]
    done = None
    for n in range(0 if last is None else last + 1):
        keys = levels.where(F.col("level") == n).select(F.col("v").alias("entity_key"))
        made = prompts(done).join(keys, "entity_key", "left_semi")
        made = graph._cut(P.document(made, None, completer, workers))
        done = made if done is None else done.unionByName(made)
    return done


def startup_prompt(f: Facts, files: DataFrame) -> DataFrame:
    """The prompt on the program's start (P10, I6, P11): main, what it reaches, its loop."""
    source = bodies(f, files)
    main = R.first_by(f.functions.where("name = 'main'").withColumn("one", F.lit(1)), ["one"], ["file", "start_line"]).select("file", "name")
    edges = f.edges.where("callee_file IS NOT NULL").select(X.key("caller_file", "caller").alias("src"), X.key("callee_file", "callee").alias("dst"))
    tree = graph.reachable(edges, main.select(X.key("file", "name").alias("v")))
    tree = tree.agg(F.to_json(F.array_sort(F.collect_list(F.struct("depth", "v")))).alias("tree"))
    direct = f.edges.join(main, (F.col("caller_file") == F.col("file")) & (F.col("caller") == F.col("name"))).select("callee_file", "callee")
    direct = direct.join(source.select(F.col("file").alias("callee_file"), F.col("name").alias("callee"), "source"), ["callee_file", "callee"])
    loop = R.main_loop(direct.withColumn("k", F.lit(1)).withColumn("c", F.struct("callee_file", "callee", "source")), "k", "callee", "callee_file")
    loop = loop.join(direct.withColumnRenamed("callee", "main_loop"), "main_loop").limit(1).select("main_loop", F.col("callee_file").alias("loop_file"), F.col("source").alias("loop"))
    called = direct.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("callee_file", "callee", "source"))), lambda x: x["source"]), "\n\n").alias("called"))
    rows = main.join(source, ["file", "name"], "left").join(tree).join(called).join(loop, F.lit(True), "left")
    return P.render(rows, "startup", "doc", F.lit("startup"), F.lit("startup"), tree=F.col("tree"), main=F.col("source"), called=F.col("called"), loop_name=F.col("main_loop"), loop_file=F.col("loop_file"), loop=F.col("loop"))


def read_project(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame | None, DataFrame, dict[str, str]]:
    """Sources, startup file, include paths and defines of a folder."""
    files = graph._cut(S.source_files(spark, root))
    other = S.source_files(spark, root, ("uvproj", "uvprojx", "ewp", "cproject", "s", "S", "txt", "mk")).union(S.source_files(spark, root, ("c", "h")).limit(0))
    other = graph._cut(other)
    best = S.startup_candidates(other).orderBy("rank", "place", "path").limit(1)
    startup = other.join(best.select("path"), "path", "left_semi").select("path", "text")
    defines = {r["name"]: r["value"] for r in S.project_defines(other).collect()}  # a project's own settings
    return files, None if startup.isEmpty() else startup, S.include_paths(other), defines
