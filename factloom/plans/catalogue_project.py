"""Queries on C projects that are made from the driver's tables: files, settings, facts, modules, prompts.

A supplier is a source file with a function, a variable and calls; regions are directories and headers.
Every query has its SQL, which derives the same facts from the tables themselves.
"""

from __future__ import annotations

import os
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sinks, store
from ..functions import text as X
from ..operators import graph as G
from ..operators import lines as L
from ..operators import modules as M
from ..operators import relational as R
from ..sources import cparse
from ..sources import files as S
from . import analyze as A
from . import prompts as P
from .catalogue import _t, query


def _f(pattern: str, **values) -> F.Column:
    """A text with columns in it: ``%name%`` stands for one."""
    parts = []
    for i, piece in enumerate(pattern.split("%")):
        if i % 2 == 0:
            parts.append(F.lit(piece))
        else:
            parts.append(F.col(values.get(piece, piece)).cast("string"))
    return F.concat(*parts)


def _suppliers(spark: SparkSession, d: str) -> DataFrame:
    nation = _t(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("r"))
    rows = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), "s_nationkey").join(nation, "s_nationkey")
    return rows.select("k", F.col("s_nationkey").alias("n"), "r", F.when((F.col("k") + 1) % 8 == 0, F.lit("end_0")).otherwise(F.concat(F.lit("f_"), (F.col("k") + 1).cast("string"))).alias("next"))


_S = "s AS (SELECT s_suppkey AS k, s_nationkey AS n, n_regionkey AS r, 'm' || n_regionkey || '/s' || s_suppkey || '.c' AS file, CASE WHEN (s_suppkey + 1) % 8 = 0 THEN 'end_0' ELSE 'f_' || (s_suppkey + 1) END AS nx FROM supplier JOIN nation ON s_nationkey = n_nationkey)"

#: Every eighth function calls one that nobody defines, so chains of calls stay short at any scale.
_SOURCE = """#include "../inc/r%r%.h"
#include "gone%n%.h"
#include <stdio.h>
static int g_%k% = %n%;
extern int far_%k%;
int %next%(int x);
/* serves
   nation %n% */
// number %k%
int f_%k%(int x)
{
    int own = x;
    struct Box_%r% box;
    g_%k% = LIMIT_%r% + own + box.a;
    return %next%(own) + ext_%n%(g_%k%);
}
#if WIDE_%r% == 2 && defined(GIVEN)
int wide_%k% = LIMIT_%r%;
#else
int lost_%k% = 9**9**8;
#endif
"""
_HEADER = """#ifndef R_%r%_H
#define R_%r%_H
#include "base.h"
#define LIMIT_%r% (%r% + \\
    1)
#define WIDE_%r% (BASE + 1)
struct Box_%r% {
    int a;
    unsigned int *b[4];
    struct { char c : 3; } in;
};
typedef struct Box_%r% box_%r%;
enum Mode_%r% { OFF_%r%, ON_%r% = 4, AUTO_%r% };
#endif
"""


def _project(spark: SparkSession, d: str) -> DataFrame:
    sources = _suppliers(spark, d).select(_f("m%r%/s%k%.c").alias("path"), _f(_SOURCE).alias("text"))
    headers = _t(spark, d, "region").select(F.col("r_regionkey").alias("r")).select(_f("inc/r%r%.h").alias("path"), _f(_HEADER).alias("text"))
    base = spark.range(1).select(F.lit("inc/base.h").alias("path"), F.lit("#pragma once\n#define BASE 1\n").alias("text"))
    rows = sources.union(headers).union(base)
    return rows.select("path", "text", F.octet_length("text").cast("long").alias("size"))


@lru_cache(4)
def _facts_of(spark: SparkSession, application: str, d: str) -> tuple[DataFrame, A.Facts]:
    files = store.written(_project(spark, d), "project")
    return files, A.facts(files, defines={"GIVEN": "1"})


def _facts(spark: SparkSession, d: str) -> tuple[DataFrame, A.Facts]:
    """The project's facts are tables of the session's shared folder, made once."""
    return _facts_of(spark, spark.sparkContext.applicationId, d)


def _joined(column: str, separator: str = ",") -> F.Column:
    return F.array_join(column, separator)


# --- files --------------------------------------------------------------------------------------


def _folder(spark: SparkSession, rows: DataFrame) -> str:
    """Rows (path, text) as files in a mounted folder of the session."""
    path = store.work_dir(spark).removeprefix("file://")
    os.makedirs(path, exist_ok=True)
    sinks.text_files(rows, path, "path", "text")
    return path


_NATION_FILE = "'d' || n_regionkey || '/n' || n_nationkey || '.c' AS path, 'int n_' || n_nationkey || ';' || chr(10) || '// ' || n_name AS text"


def _nation_files(spark, d):
    return _t(spark, d, "nation").select(_f("d%n_regionkey%/n%n_nationkey%.c").alias("path"), _f("int n_%n_nationkey%;\n// %n_name%").alias("text"))


@query(f"SELECT path, text, strlen(text) AS size FROM (SELECT {_NATION_FILE} FROM nation)")
def q_source_files(spark, d):
    """Files written, one a row, then found again."""
    rows = _nation_files(spark, d)
    return S.source_files(spark, _folder(spark, rows.union(rows.select(F.concat("path", F.lit(".txt")), "text"))))


@query(f"SELECT path, false AS is_dir FROM (SELECT {_NATION_FILE} FROM nation) UNION ALL SELECT DISTINCT 'd' || n_regionkey, true FROM nation")
def q_list_tree(spark, d):
    """S22, P9."""
    rows = _nation_files(spark, d)
    other = rows.select(F.concat(F.lit("build/"), "path"), "text").union(rows.select(F.concat("path", F.lit(".O")), "text"))
    return S.list_tree(spark, _folder(spark, rows.union(other)))


@query(f"SELECT 'd' || n_regionkey AS path, true AS is_dir FROM nation GROUP BY 1")
def q_list_tree_depth(spark, d):
    """L6 of S22: only the first level."""
    return S.list_tree(spark, _folder(spark, _nation_files(spark, d)), 1)


@query("""SELECT 'k' || n_nationkey AS name, CASE WHEN n_nationkey % 5 > 0 THEN n_name END AS value FROM nation""")
def q_json_facts(spark, d):
    """A malformed file is a row of nulls."""
    body = F.when(F.col("n_nationkey") % 5 > 0, _f('{"name": "k%n_nationkey%",\n "value": "%n_name%"}')).otherwise(F.lit("{no json"))
    rows = _t(spark, d, "nation").select(_f("k%n_nationkey%.json").alias("path"), body.alias("text"))
    schema = T.StructType.fromDDL("name string, value string")
    read = S.read_facts(spark, "file://" + _folder(spark, rows), schema).select("name", "value", F.col("_metadata.file_name").alias("at"))
    return read.select(F.coalesce("name", X.stem("at")).alias("name"), "value")


@query("""SELECT 'p' || n_nationkey || '/app.uvprojx' AS project, unnest([0, 1]) AS ord, 'p' || n_nationkey || unnest(['/inc' || n_regionkey, '/./src/' || n_name]) AS dir FROM nation
UNION ALL SELECT 'p' || n_nationkey || '/.cproject', unnest([0, 1]), unnest(['/opt/' || n_regionkey, 'p' || n_nationkey || '/lib']) FROM nation""")
def q_include_paths(spark, d):
    """Both kinds of project files."""
    nation = _t(spark, d, "nation")
    keil = nation.select(_f("p%n_nationkey%/app.uvprojx").alias("path"), _f("<A><IncludePath>inc%n_regionkey%;.\\src\\%n_name%; ;inc%n_regionkey%</IncludePath></A>").alias("text"))
    option = '<option superClass="gnu.c.compiler.option.include.paths"><listOptionValue builtIn="false" value="&quot;/opt/%n_regionkey%&quot;"/><listOptionValue value="${workspace_loc:/${ProjName}/lib}"/></option>'
    cdt = nation.select(_f("p%n_nationkey%/.cproject").alias("path"), _f(option).alias("text"))
    return S.include_paths(keil.union(cdt))


@query("""SELECT name, arg_max(value, path) AS value FROM (SELECT 'L' || n_regionkey AS name, n_name AS value, 'p' || n_nationkey || '.uvproj' AS path FROM nation
UNION ALL SELECT 'B' || n_nationkey, '1', 'p' FROM nation) GROUP BY name""")
def q_defines(spark, d):
    """A bare name is 1, the last definition wins."""
    rows = _t(spark, d, "nation").select(_f("p%n_nationkey%.uvproj").alias("path"), _f("<Define>B%n_nationkey%, L%n_regionkey%=%n_name%</Define>").alias("text"))
    return S.project_defines(rows)


@query("""SELECT 'D' || n_nationkey AS name, n_name || '=x' AS value FROM nation""")
def q_defines_cdt(spark, d):
    """A value is cut off at the first equals sign only."""
    option = '<option superClass="gnu.c.compiler.option.preprocessor.def.symbols"><listOptionValue value="D%n_nationkey%=%n_name%=x"/></option>'
    return S.project_defines(_t(spark, d, "nation").select(_f("p%n_nationkey%/.cproject").alias("path"), _f(option).alias("text")))


@query("""SELECT '-I' || unnest(['root', 'root/include', 'root/inc', 'root/src', 'root/Core/Inc']) AS argument UNION ALL SELECT DISTINCT '-I' || n_regionkey FROM nation
UNION ALL SELECT '-DN' || n_nationkey || '=' || n_name FROM nation""")
def q_compiler_arguments(spark, d):
    """A project's own settings, on the driver."""
    rows = _t(spark, d, "nation").orderBy("n_nationkey").collect()
    made = S.compiler_arguments("root", [str(r.n_regionkey) for r in rows], {f"N{r.n_nationkey}": r.n_name for r in rows})
    return spark.createDataFrame([(x,) for x in made], "argument string")


@query("""WITH c AS (SELECT n_nationkey AS k, n_nationkey % 4 AS m FROM nation)
SELECT rank, place, path FROM (
SELECT 0 AS rank, 3 AS place, 'q' || k || '/startup_dev.s' AS path FROM c WHERE m = 0
UNION ALL SELECT 0, 0, 'q' || k || '/low/startup_dev.s' FROM c WHERE m = 1
UNION ALL SELECT 2, 0, 'q' || k || '/startup_dev.s' FROM c WHERE m = 0 UNION ALL SELECT 2, 0, 'q' || k || '/low/startup_dev.s' FROM c WHERE m = 1
UNION ALL SELECT 2, 0, 'q' || k || '/boot.s' FROM c WHERE m = 2 UNION ALL SELECT 1, 6, 'startup/startup.s' UNION ALL SELECT 2, 0, 'startup/startup.s')""")
def q_startup_candidates(spark, d):
    """Named by a build file, in a well-known place, or by content."""
    c = _t(spark, d, "nation").select(F.col("n_nationkey").alias("k"), (F.col("n_nationkey") % 4).alias("m"))
    asm = F.lit("Reset_Handler PROC")
    rows = c.where("m = 0").select(_f("q%k%/startup_dev.s").alias("path"), asm.alias("text")).union(c.where("m = 0").select(_f("q%k%/Makefile"), F.lit("SRC = ./startup_dev.s other.c\n")))
    rows = rows.union(c.where("m = 1").select(_f("q%k%/low/startup_dev.s"), asm)).union(c.where("m = 1").select(_f("q%k%/app.uvprojx"), F.lit("<File>low\\startup_dev.s</File>")))
    rows = rows.union(c.where("m = 2").select(_f("q%k%/boot.s"), asm)).union(c.where("m = 3").select(_f("q%k%/none.s"), F.lit("NOP")))
    return S.startup_candidates(rows.union(spark.range(1).select(F.lit("startup/startup.s"), asm))).select("rank", "place", "path")


def _assembler(spark, d):
    body = "__Vectors DCD __initial_sp\n DCD Reset_Handler\n DCD H%k%_Handler ; x\n__Vectors_End\n DCD Late\nFirst%k% PROC\n ENDP\nReset_Handler PROC\n EXPORT H%k%_Handler [WEAK]\n EXPORT f_%k% [WEAK]\n EXPORT S%k%\n LDR R0, =SystemInit\n LDR R0, =__main\n BL f_%k%\n ENDP\n"
    rows = _suppliers(spark, d).select(_f("start%k%.s").alias("path"), F.when(F.col("k") % 3 > 0, _f(body)).otherwise(_f("Only%k% PROC\n")).alias("text"))
    return rows


@query(f"WITH {_S} SELECT 'start' || k || '.s' AS path, unnest([0, 1, 2]) AS index, unnest(['__initial_sp', 'Reset_Handler', 'H' || k || '_Handler']) AS handler FROM s WHERE k % 3 > 0")
def q_startup_vectors(spark, d):
    """H15, S21."""
    return S.startup_facts(_assembler(spark, d))[0]


@query(f"WITH {_S} SELECT 'start' || k || '.s' AS path, unnest(['H' || k || '_Handler', 'f_' || k, 'S' || k]) AS name, unnest([true, true, false]) AS is_weak FROM s WHERE k % 3 > 0")
def q_startup_exports(spark, d):
    """H17, S21."""
    return S.startup_facts(_assembler(spark, d))[1]


@query(f"WITH {_S} SELECT 'start' || k || '.s' AS path, CASE WHEN k % 3 > 0 THEN 'Reset_Handler' ELSE 'Only' || k END AS entry FROM s")
def q_startup_entry(spark, d):
    """H16."""
    return S.startup_facts(_assembler(spark, d))[2]


@lru_cache(4)
def _started(spark: SparkSession, application: str, d: str) -> A.Facts:
    k = _suppliers(spark, d).where("k % 3 > 0").agg(F.min("k").alias("k"))
    startup = _assembler(spark, d).join(k, F.col("path") == _f("start%k%.s"), "left_semi")
    return A.facts(_project(spark, d), startup)


@query(f"""WITH {_S}, one AS (SELECT min(k) AS k FROM s WHERE k % 3 > 0)
SELECT 'start' || k || '.s' AS caller_file, 'Reset_Handler' AS caller, unnest([NULL, NULL, (SELECT file FROM s WHERE s.k = one.k)]) AS callee_file, unnest(['SystemInit', 'main', 'f_' || k]) AS callee FROM one""")
def q_startup_calls(spark, d):
    """The startup file's entry joins the call graph."""
    return _started(spark, spark.sparkContext.applicationId, d).edges.where("caller = 'Reset_Handler'")


@query(f"""WITH {_S}, one AS (SELECT min(k) AS k FROM s WHERE k % 3 > 0)
SELECT 'start' || k || '.s' AS file, unnest(['H' || k || '_Handler', 'S' || k, 'Reset_Handler']) AS name FROM one""")
def q_startup_functions(spark, d):
    """A weak name that is defined elsewhere isn't added."""
    return _started(spark, spark.sparkContext.applicationId, d).functions.where("start_line < 0").select("file", "name")


# --- facts --------------------------------------------------------------------------------------


@query(f"WITH {_S} SELECT file, 'f_' || k AS name, 10 AS start_line, 16 AS end_line FROM s")
def q_functions(spark, d):
    """Declarations are no functions."""
    return _facts(spark, d)[1].functions.select("file", "name", "start_line", "end_line")


@query(f"""WITH {_S} SELECT a.file AS caller_file, 'f_' || a.k AS caller, b.file AS callee_file, a.nx AS callee FROM s a LEFT JOIN s b ON 'f_' || b.k = a.nx
UNION ALL SELECT file, 'f_' || k, NULL, 'ext_' || n FROM s""")
def q_project_edges(spark, d):
    """A2, J1, J19, I12."""
    return _facts(spark, d)[1].edges.select("caller_file", "caller", "callee_file", "callee")


@query("""SELECT 'LIMIT_' || r_regionkey AS name, 'inc/r' || r_regionkey || '.h' AS defined_in, '(' || r_regionkey || ' +' || chr(10) || '1)' AS content FROM region
UNION ALL SELECT 'WIDE_' || r_regionkey, 'inc/r' || r_regionkey || '.h', '(BASE + 1)' FROM region UNION ALL SELECT 'BASE', 'inc/base.h', '1'""")
def q_macros(spark, d):
    """Guards are no macros."""
    return _facts(spark, d)[1].macros.select("name", "defined_in", "content")


@query(f"WITH {_S} SELECT 'LIMIT_' || r AS name, file AS use_file, unnest(['f_' || k, 'global']) AS use_function FROM s")
def q_macro_uses(spark, d):
    """The second use stands in a branch that a macro of an included header opens."""
    return _facts(spark, d)[1].macro_uses.where("name <> 'BASE'").select("name", "use_file", "use_function")


@query(f"WITH {_S} SELECT 'g_' || k AS name, 'int' AS type_text, file AS defined_in, 4 AS line FROM s UNION ALL SELECT 'wide_' || k, 'int', file, 18 FROM s")
def q_globals(spark, d):
    """Extern declarations vanish, and so do branches that are off."""
    return _facts(spark, d)[1].globals_.select("name", "type_text", "defined_in", "line")


@query("""SELECT 'Box_' || r_regionkey AS type_name, unnest(['', '', '', '/in']) AS parent_path, unnest(['a', 'b', 'in', 'c']) AS name, unnest(['int', 'unsigned int *[4]', 'struct', 'char : 3']) AS type_text FROM region""")
def q_fields(spark, d):
    """Nested members come with the path of the one that holds them."""
    return _facts(spark, d)[1].fields.select("type_name", "parent_path", "name", "type_text")


@query("""SELECT 'Mode_' || r_regionkey AS type_name, unnest(['OFF_', 'ON_', 'AUTO_']) || r_regionkey AS name, unnest([0, 4, 5])::BIGINT AS value FROM region""")
def q_enum_values(spark, d):
    """H25."""
    return _facts(spark, d)[1].enum_values.select("type_name", "name", "value")


@query("""SELECT 'box_' || r_regionkey AS alias, 'Box_' || r_regionkey AS target, 'inc/r' || r_regionkey || '.h' AS file FROM region""")
def q_typedefs(spark, d):
    """H21, J16."""
    return _facts(spark, d)[1].typedefs.select("alias", "target", "file")


@query(f"WITH {_S} SELECT 'Box_' || r AS name, file AS use_file, 'f_' || k AS use_function FROM s")
def q_uses_in_functions(spark, d):
    """The typedef's own use of its type stands outside of all functions."""
    return A.in_functions(_facts(spark, d)[1].type_uses).select("name", "use_file", "use_function")


@query(f"""WITH {_S} SELECT file, unnest(['inc/r' || r || '.h', 'gone' || n || '.h', 'stdio.h']) AS included FROM s
UNION ALL SELECT 'inc/r' || r_regionkey || '.h', 'inc/base.h' FROM region""")
def q_includes(spark, d):
    """J5."""
    return _facts(spark, d)[1].includes.select("file", "included")


@query(f"WITH {_S} SELECT file, 'gone' || n || '.h' AS wanted FROM s")
def q_missing_includes(spark, d):
    """Headers of the C library aside, includes that no file answers."""
    return A.missing_includes(_project(spark, d))


@query(f"""WITH {_S} SELECT unnest(['functions', 'macros', 'types', 'globals', 'files', 'calls']) AS kind,
unnest([count(*), 2 * (SELECT count(*) FROM region) + 1, 2 * (SELECT count(*) FROM region), 2 * count(*), count(*) + (SELECT count(*) FROM region) + 1, 2 * count(*)]) AS n FROM s""")
def q_progress(spark, d):
    """A18."""
    return A.progress(_facts(spark, d)[1])


@query(f"""WITH RECURSIVE {_S}, e AS (SELECT a.file || ':f_' || a.k AS src, coalesce(b.file || ':', 'unknown:') || a.nx AS dst FROM s a LEFT JOIN s b ON 'f_' || b.k = a.nx
UNION SELECT file || ':f_' || k, 'unknown:ext_' || n FROM s), w AS (SELECT DISTINCT src AS v, 0 AS i FROM e WHERE src NOT IN (SELECT dst FROM e) UNION ALL SELECT dst, i + 1 FROM w JOIN e ON v = src),
m AS (SELECT v, max(i) AS i FROM w GROUP BY v) SELECT v, ((SELECT max(i) FROM m) - i)::INT AS level FROM m""")
def q_function_levels(spark, d):
    """The chain of calls, where an unknown callee comes right after its last caller."""
    return A.function_levels(_facts(spark, d)[1])


# --- records and sinks --------------------------------------------------------------------------


@query(f"""WITH {_S}, e AS (SELECT a.file || ':f_' || a.k AS key, coalesce(b.file || ':', 'unknown:') || a.nx AS callee FROM s a LEFT JOIN s b ON 'f_' || b.k = a.nx
UNION ALL SELECT file || ':f_' || k, 'unknown:ext_' || n FROM s) SELECT key, string_agg(callee, ',' ORDER BY callee) AS callees FROM e GROUP BY key""")
def q_call_graph_records(spark, d):
    """K1."""
    f = _facts(spark, d)[1]
    return sinks.call_graph_records(f.edges, f.functions).select("key", _joined("callees").alias("callees"))


@query(f"""WITH {_S}, i AS (SELECT file, unnest(['inc/r' || r || '.h', 'gone' || n || '.h', 'stdio.h']) AS x FROM s)
SELECT file, 'f_' || k AS functions, string_agg(x, ',' ORDER BY x) AS includes FROM s JOIN i USING (file) GROUP BY file, k
UNION ALL SELECT 'inc/r' || r_regionkey || '.h', NULL, 'inc/base.h' FROM region UNION ALL SELECT 'inc/base.h', NULL, NULL""")
def q_file_records(spark, d):
    """K3, P17."""
    f = _facts(spark, d)[1]
    rows = sinks.file_records(f.functions, f.includes, f.files)
    return rows.select("file", F.array_join("functions.name", ",").alias("functions"), F.array_join("includes", ",").alias("includes"))


@query(f"""WITH {_S}, u AS (SELECT r, string_agg(file || ':f_' || k, ',' ORDER BY file || ':f_' || k) AS x FROM s GROUP BY r)
SELECT 'struct' AS kind, 'Box_' || r_regionkey AS name, 4 AS fields, NULL::INT AS values, coalesce('inc/r' || r_regionkey || '.h:global,' || x, 'inc/r' || r_regionkey || '.h:global') AS used_by FROM region LEFT JOIN u ON r = r_regionkey
UNION ALL SELECT 'enum', 'Mode_' || r_regionkey, NULL, 3, '' FROM region""")
def q_type_records(spark, d):
    """K5, J7, J17."""
    f = _facts(spark, d)[1]
    rows = sinks.type_records(f.types, f.fields, f.enum_values, f.type_uses)
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c))
    return rows.select("kind", "name", size("fields").alias("fields"), size("values").alias("values"), _joined("used_by").alias("used_by"))


@query(f"""WITH {_S}, u AS (SELECT 'LIMIT_' || r AS name, file || unnest([':f_' || k, ':global']) AS x FROM s UNION ALL SELECT 'BASE', 'x' FROM s WHERE false)
SELECT m.name, coalesce(string_agg(x, ',' ORDER BY x), '') AS used_in FROM (SELECT unnest(['LIMIT_', 'WIDE_']) || r_regionkey AS name FROM region UNION ALL SELECT 'BASE') m LEFT JOIN u USING (name) GROUP BY m.name""")
def q_macro_records(spark, d):
    """K6, A3."""
    f = _facts(spark, d)[1]
    return sinks.used_records(f.macros, f.macro_uses).select("name", _joined("used_in").alias("used_in"))


@query(f"WITH {_S} SELECT 'g_' || k AS name, file || ':f_' || k AS used_in FROM s UNION ALL SELECT 'wide_' || k, '' FROM s")
def q_global_records(spark, d):
    """K7: a local of another name doesn't hide it."""
    f = _facts(spark, d)[1]
    return sinks.used_records(f.globals_, f.global_uses).select("name", _joined("used_in").alias("used_in"))


@query("""SELECT 'Region ' || r_regionkey AS path, CASE WHEN r_regionkey = (SELECT max(r_regionkey) FROM region) THEN '└── ' ELSE '├── ' END || 'Region ' || r_regionkey AS line FROM region
UNION ALL SELECT 'Region ' || n_regionkey || '/' || n_name, CASE WHEN n_regionkey = (SELECT max(r_regionkey) FROM region) THEN '    ' ELSE '│   ' END ||
CASE WHEN n_name = max(n_name) OVER (PARTITION BY n_regionkey) THEN '└── ' ELSE '├── ' END || n_name FROM nation""")
def q_file_tree(spark, d):
    """K4, I5."""
    paths = _t(spark, d, "nation").select(_f("Region %n_regionkey%/%n_name%").alias("path"))
    return M.tree_text(M.path_tree(paths, "path"))


@query("""SELECT '{' || chr(10) || string_agg('  "r' || r_regionkey || '": {' || coalesce(x, '') || '}', ',' || chr(10) ORDER BY 'r' || r_regionkey) || chr(10) || '}' AS tree FROM region
LEFT JOIN (SELECT n_regionkey, chr(10) || string_agg('    "n' || n_nationkey || '": {}', ',' || chr(10) ORDER BY 'n' || n_nationkey) || chr(10) || '  ' AS x FROM nation GROUP BY 1) ON n_regionkey = r_regionkey""")
def q_tree_json(spark, d):
    """A listing as one nested object, which is one value."""
    rows = _t(spark, d, "region").select(_f("r%r_regionkey%").alias("p")).union(_t(spark, d, "nation").select(_f("r%n_regionkey%/n%n_nationkey%")))
    return spark.createDataFrame([(sinks.tree_json([r.p for r in rows.collect()]),)], "tree string")


@query("""WITH e AS (SELECT 'r' || n_regionkey AS src, 'n' || n_nationkey AS dst FROM nation)
SELECT 'r' || r_regionkey AS line, 'r' || r_regionkey AS at FROM region UNION ALL SELECT '  ' || dst, src || '/' || dst FROM e UNION ALL
SELECT '    s' || s_suppkey, src || '/' || dst || '/s' || s_suppkey FROM e JOIN supplier ON dst = 'n' || s_nationkey""")
def q_call_tree(spark, d):
    """K2, I4: paths from the roots as indented lines, all depths."""
    k = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = _t(spark, d, "nation").select(k("r", "n_regionkey").alias("src"), k("n", "n_nationkey").alias("dst"))
    edges = edges.union(_t(spark, d, "supplier").select(k("n", "s_nationkey"), k("s", "s_suppkey")))
    roots = G.roots(edges, _t(spark, d, "region").select(k("r", "r_regionkey").alias("v"))).where("v LIKE 'r%'")
    return G.tree_text(G.call_paths(edges, roots)).select("line", F.array_join("path", "/").alias("at"))


# --- modules ------------------------------------------------------------------------------------

_TOWN = "t AS (SELECT n_nationkey AS k, n_regionkey AS r, 'reg' || n_regionkey || '/town_' || lpad(n_nationkey::VARCHAR, 2, '0') || '.c' AS file FROM nation)"


def _towns(spark, d):
    """Files, functions and edges of a small project: towns of a region call each other in turn, regions the next region."""
    at = lambda r, k: F.concat(F.lit("reg"), F.col(r).cast("string"), F.lit("/town_"), F.lpad(F.col(k).cast("string"), 2, "0"), F.lit(".c"))
    from pyspark.sql import Window

    w = Window.partitionBy("n_regionkey").orderBy("n_nationkey")
    towns = _t(spark, d, "nation").withColumn("next", F.lead("n_nationkey").over(w)).withColumn("first", F.row_number().over(w) == 1)
    towns = towns.select(at("n_regionkey", "n_nationkey").alias("file"), "n_nationkey", "n_regionkey", "first", F.when(F.col("next").isNotNull(), at("n_regionkey", "next")).alias("next"))
    files = towns.select("file", F.lit(100).cast("long").alias("size")).union(spark.range(1).select(F.lit("reg0/only.h"), F.lit(5).cast("long")))
    functions = towns.select("file", F.concat(F.lit("town"), F.col("n_nationkey").cast("string")).alias("name"))
    heads = towns.where("first").select("n_regionkey", F.col("file").alias("head"))
    following = heads.select((F.col("n_regionkey") - 1).alias("n_regionkey"), F.col("head").alias("dst"))
    back = heads.where("n_regionkey = 0").select(F.lit(4).alias("n_regionkey"), F.col("head").alias("dst"))
    edges = towns.where("next IS NOT NULL").select(F.col("file").alias("src"), F.col("next").alias("dst"))
    edges = edges.union(heads.join(following.union(back.select(F.col("n_regionkey").cast("int"), "dst")), "n_regionkey").select("head", "dst"))
    return files, functions, edges


@lru_cache(4)
def _modules_of(spark: SparkSession, application: str, d: str):
    files, functions, edges = _towns(spark, d)
    return tuple(store.written(x, "modules") for x in M.assemble(files, functions, edges))


def _modules(spark, d):
    return _modules_of(spark, spark.sparkContext.applicationId, d)


@query(f"WITH {_TOWN} SELECT 'reg' || r || '/town' AS module, row_number() OVER (PARTITION BY r ORDER BY file)::INT AS ord, file FROM t")
def q_modules(spark, d):
    """A module per region, named by the files' common prefix, told apart by the directory."""
    return _modules(spark, d)[0]


@query("""SELECT 'reg' || r_regionkey || '/town' AS module, 'reg' || (r_regionkey + 1) || '/town' AS dependency FROM region WHERE r_regionkey < 4""")
def q_module_dependencies(spark, d):
    """The last region's call of the first one closes a cycle and goes."""
    return _modules(spark, d)[1]


@query(f"WITH {_TOWN} SELECT 'reg' || r || '/town' AS module, string_agg(file, ',' ORDER BY file) AS files, CASE WHEN r < 4 THEN 'reg' || (r + 1) || '/town' ELSE '' END AS dependencies FROM t GROUP BY r")
def q_module_records(spark, d):
    """K8, K9, L1."""
    return sinks.module_records(*_modules(spark, d)).select("module", _joined("files").alias("files"), _joined("dependencies").alias("dependencies"))


@query("""SELECT 'reg' || r_regionkey || '/town' AS v, (4 - r_regionkey)::INT AS level FROM region""")
def q_module_levels(spark, d):
    """I2."""
    members, deps = _modules(spark, d)
    return G.levels(deps.select(F.col("module").alias("src"), F.col("dependency").alias("dst")), members.select(F.col("module").alias("v")))


# --- prompts ------------------------------------------------------------------------------------


@query(f"""WITH {_S} SELECT file, 'f_' || k AS name, '/* serves' || chr(10) || '   nation ' || n || ' */' || chr(10) || '// number ' || k || chr(10) || 'int f_' || k || '(int x)' || chr(10) || '{{' || chr(10) || '    int own = x;' || chr(10) ||
'    struct Box_' || r || ' box;' || chr(10) || '    g_' || k || ' = LIMIT_' || r || ' + own + box.a;' || chr(10) || '    return ' || nx || '(own) + ext_' || n || '(g_' || k || ');' || chr(10) || '}}' AS source FROM s""")
def q_documented_bodies(spark, d):
    """Bodies with the comments above them."""
    files, f = _facts(spark, d)
    return A.bodies(f, files)


@query(f"""WITH {_S} SELECT k, CASE WHEN k % 7 = 0 THEN '// no source for gone.c:' || k ELSE 'int ' || nx || '(int x);' END AS body FROM s""")
def q_slice_or_comment(spark, d):
    """A slice of a missing file is a comment that says so."""
    s = _suppliers(spark, d)
    gone = F.col("k") % 7 == 0
    ranges = s.select("k", F.when(gone, F.lit("gone.c")).otherwise(_f("m%r%/s%k%.c")).alias("path"), F.when(gone, F.col("k")).otherwise(6).cast("int").alias("a"), F.lit(6).alias("b"))
    return L.documented_slices(ranges, _project(spark, d), "path", "text", "a", "b").select("k", "body")


@query(f"WITH {_S} SELECT file, 7 AS fixed, 7 AS quirk FROM s")
def q_comment_start(spark, d):
    """H3: the kept flaw makes no difference where no block comment of one line stands above."""
    rows = _project(spark, d).where("path LIKE 'm%'")
    c = L.comment_lines(F.col("text"))
    at = lambda *more: L.doc_comment_start(c, F.lit(10), *more).cast("int")
    return rows.select(F.col("path").alias("file"), at().alias("fixed"), at(F.split("text", "\n", -1)).alias("quirk"))


@query(f"""WITH {_S}, b AS (SELECT s.*, coalesce(n.file || ':', 'unknown:') || s.nx AS one, 'unknown:ext_' || s.n AS two, n.k AS nk, p.file || ':f_' || p.k AS back FROM s LEFT JOIN s n ON 'f_' || n.k = s.nx LEFT JOIN s p ON p.nx = 'f_' || s.k)
SELECT file || ':f_' || k AS entity_key, 'function' AS entity_kind, 'doc' AS stage, 'functions/' || file || '/f_' || k AS path,
'["' || least(one, two) || '","' || greatest(one, two) || '"]' AS callees, coalesce('["' || back || '"]', 'none') AS callers, coalesce(one || ': told ' || nk, 'none') AS known FROM b""")
def q_function_prompts(spark, d):
    """What a prompt says of callees, callers and what is known of them."""
    files, f = _facts(spark, d)
    docs = _suppliers(spark, d).select(_f("m%r%/s%k%.c:f_%k%").alias("entity_key"), _f("# x\n### Function\ntold %k%\n## rest").alias("response"))
    rows = A.function_prompts(f, files, docs)
    part = lambda a, b: F.trim(F.regexp_extract("prompt", f"(?s){a}:\n(.*?)\n\n{b}", 1))
    callers = F.regexp_extract("prompt", "(?s)It is called by:\n(.*?)\n$", 1)
    return rows.select("entity_key", "entity_kind", "stage", "path", part("It calls", "What").alias("callees"), callers.alias("callers"), part("What is known of these", "It is called").alias("known"))


@query("""SELECT 'reg' || r_regionkey || '/town' AS module, CASE WHEN r_regionkey < 4 THEN 'reg' || (r_regionkey + 1) || '/town: duty ' || (r_regionkey + 1) END AS known FROM region WHERE r_regionkey < 4""")
def q_dependency_docs(spark, d):
    """Of each dependency's document the section on its duties."""
    docs = _t(spark, d, "region").select(_f("reg%r_regionkey%/town").alias("entity_key"), _f("intro\n### Duties\nduty %r_regionkey%\n### Other\nx").alias("response"))
    return A.told(_modules(spark, d)[1], docs, "module", "dependency")


@query(f"""WITH {_S}, l AS (SELECT 'leaf ' || k AS p, k FROM s), a AS (SELECT k, 'stub:' || md5(p) AS d FROM l)
SELECT 'e' || k AS v, 0 AS level, d AS response FROM a UNION ALL SELECT 'r' || k, 1, 'stub:' || md5('root ' || k || ' knows ' || d) FROM a""")
def q_level_barrier(spark, d):
    """What a level says is known to the next one."""
    s = _suppliers(spark, d)
    levels = s.select(_f("e%k%").alias("v"), F.lit(0).alias("level"), "k").union(s.select(_f("r%k%"), F.lit(1), "k"))

    def prompts(done):
        rows = levels.select(F.lit("x").alias("entity_kind"), F.col("v").alias("entity_key"), F.lit("doc").alias("stage"), F.lit("p").alias("path"), "k", "level")
        if done is None:
            return rows.select("entity_kind", "entity_key", "stage", "path", _f("leaf %k%").alias("prompt"))
        known = done.select(F.regexp_extract("entity_key", r"\d+", 0).cast("long").alias("k"), "response")
        return rows.join(known, "k").select("entity_kind", "entity_key", "stage", "path", _f("root %k% knows %response%").alias("prompt"))

    done = A._by_level(levels.select("v", "level"), prompts, P.OfflineStub(), 2)
    return done.select(F.col("entity_key").alias("v"), F.when(F.startswith("entity_key", F.lit("e")), 0).otherwise(1).alias("level"), "response")


@query(f"""WITH {_S} SELECT 'e' || k AS entity_key, CASE WHEN k % 2 = 0 THEN 'function' ELSE 'struct' END AS entity_kind, 'train/p' || k AS path,
CASE WHEN k % 2 = 0 THEN 'Write questions and answers on this function.' || chr(10) || chr(10) || 'doc ' || k || chr(10) || chr(10) || 'src ' || k || chr(10) ELSE 'Write questions and answers on this type.' || chr(10) || chr(10) || 'doc ' || k || chr(10) END AS prompt FROM s""")
def q_train_prompts(spark, d):
    """S24, J14, U5."""
    kind = F.when(F.col("k") % 2 == 0, "function").otherwise("struct")
    s = _suppliers(spark, d)
    docs = s.select(kind.alias("entity_kind"), _f("e%k%").alias("entity_key"), F.lit("doc").alias("stage"), _f("p%k%").alias("path"), F.lit("").alias("prompt"), _f("doc %k%").alias("response"))
    sources = s.select(F.lit("function").alias("entity_kind"), _f("e%k%").alias("entity_key"), _f("src %k%").alias("source"))
    return P.train_prompts(docs, sources).select("entity_key", "entity_kind", "path", "prompt")


@query(f"""WITH {_S}, u AS (SELECT 'LIMIT_' || r AS name, file || ':f_' || k AS u FROM s), p AS (SELECT name, u FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY md5('s1' || u), u) AS i FROM u) WHERE i <= 5)
SELECT name, string_agg(u, ',' ORDER BY u) AS users FROM p GROUP BY name""")
def q_user_samples(spark, d):
    """A seeded sample of users, each with its source."""
    files, f = _facts(spark, d)
    rows = A.user_samples(A.in_functions(f.macro_uses), A.bodies(f, files), 5)
    return rows.select("name", _joined("users").alias("users"))


@query(f"""WITH {_S} SELECT 'Box_' || r_regionkey AS name, 'struct Box_' || r_regionkey || ' {{' || chr(10) || '    int a;' || chr(10) || '    unsigned int *b[4];' || chr(10) || '    struct {{ char c : 3; }} in;' || chr(10) || '}};' AS definition FROM region
UNION ALL SELECT 'Mode_' || r_regionkey, 'enum Mode_' || r_regionkey || ' {{ OFF_' || r_regionkey || ', ON_' || r_regionkey || ' = 4, AUTO_' || r_regionkey || ' }};' FROM region""")
def q_type_definitions(spark, d):
    """A type's definition as it stands in the source."""
    files, f = _facts(spark, d)
    prompt = A.entity_prompts(f, files, "struct")
    return prompt.select(F.split_part("entity_key", F.lit(":"), F.lit(2)).alias("name"), F.regexp_extract("prompt", r"(?s)defined in [^\n]*\n\n(.*?)\n\nFacts", 1).alias("definition"))


@query(f"""WITH {_S}, m AS (SELECT arg_min(k, file) AS k, min(file) AS file FROM s) SELECT 'startup' AS entity_key, file AS loop_file FROM (SELECT file FROM m)""")
def q_startup_prompt(spark, d):
    """Main by the smallest file, its loop among what it calls."""
    s = _suppliers(spark, d).select(_f("m%r%/s%k%.c").alias("file"), "k")
    rows = s.agg(F.min_by("k", "file").alias("k"), F.min("file").alias("file"))
    text = _f("void helper(void) { }\nvoid task_%k%(void) { }\nint main(void)\n{\n    helper();\n    task_%k%();\n    return 0;\n}\n")
    files = rows.select("file", text.alias("text")).union(s.select(F.concat(F.lit("z/"), "file"), F.lit("int main(void) { return 1; }\n")))
    files = files.select(F.col("file").alias("path"), "text", F.octet_length("text").cast("long").alias("size"))
    made = A.startup_prompt(A.facts(files), files)
    return made.select("entity_key", F.regexp_extract("prompt", r"Main loop task_\d+ in ([^:]*):", 1).alias("loop_file"))


# --- scalar functions ---------------------------------------------------------------------------


@query("""SELECT p_partkey, 'a ' || chr(10) || ' ' || p_size || ' // ' || p_name AS bare FROM part""")
def q_strip_comments(spark, d):
    """H2: block comments go, line breaks and line comments stay."""
    return _t(spark, d, "part").select("p_partkey", L.strip_block_comments(_f("a /* %p_name%\n%p_type% */ %p_size% // %p_name%")).alias("bare"))


@query("""SELECT p_partkey, '#define M' || p_partkey || '(a) a \\' || chr(10) || '    + ' || p_size AS text, '#define N ' || p_size AS plain FROM part""")
def q_macro_text(spark, d):
    """H7."""
    rows = _t(spark, d, "part")
    return rows.select("p_partkey", X.macro_text(_f("M%p_partkey%"), F.lit("(a)"), _f("a\n+ %p_size%")).alias("text"), X.macro_text(F.lit("N"), F.lit(None).cast("string"), F.col("p_size").cast("string")).alias("plain"))


@query("""SELECT p_partkey, 'f' || p_partkey || '.tar.c' AS base, 'd/' || p_size AS dir, 'f' || p_partkey || '.tar' AS stem, 'd/' || p_brand || '/x.c' AS normal, 'd:' || p_name AS key FROM part""")
def q_paths(spark, d):
    """H9, H10."""
    p = _f("d/%p_size%/f%p_partkey%.tar.c")
    normal = X.normal_path(_f("./d/%p_size%/../%p_brand%//x.c"))
    return _t(spark, d, "part").select("p_partkey", X.base_name(p).alias("base"), X.dir_name(p).alias("dir"), X.stem(p).alias("stem"), normal.alias("normal"), X.key(F.lit("d"), F.col("p_name")).alias("key"))


@query("""SELECT p_brand, coalesce('- ' || string_agg(DISTINCT p_type, chr(10) || '- ' ORDER BY p_type) FILTER (p_size < 3), 'none') AS items, '["' || p_brand || '"]' AS js FROM part GROUP BY p_brand""")
def q_bullets(spark, d):
    """H13, H14."""
    rows = _t(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set(F.when(F.col("p_size") < 3, F.col("p_type")))).alias("x"))
    return rows.select("p_brand", X.bullets("x").alias("items"), F.to_json(F.array("p_brand")).alias("js"))


@query("""SELECT p_partkey, 'A' || p_partkey || ',B_' || p_size AS defined, 'MAX,A' || p_partkey || ',_X' AS upper, 'a/' || p_size || '.h,b.h' AS included FROM part""")
def q_scans(spark, d):
    """Names by pattern alone."""
    rows = _t(spark, d, "part")
    found = lambda text, pattern: F.array_join(X.all_matches(text, pattern), ",")
    defines = _f("#define A%p_partkey% 1\nx #define NO\n  #  define B_%p_size%(x) x\n")
    return rows.select("p_partkey", found(defines, X.MACRO_NAMES).alias("defined"), found(_f("MAX(a, A%p_partkey%) + _X - aB"), X.UPPER_NAMES).alias("upper"), found(_f('#include "a/%p_size%.h"\n# include <b.h>\n//#include "c.h"'), X.INCLUDE_NAMES).alias("included"))


@query("""SELECT p_partkey, p_name FROM part WHERE p_size % 3 > 0""")
def q_named(spark, d):
    """Blank and null names go."""
    name = F.when(F.col("p_size") % 3 > 0, F.col("p_name")).when(F.col("p_size") % 2 == 0, F.lit("  "))
    return R.named(_t(spark, d, "part").select("p_partkey", name.alias("p_name")), "p_name")


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 3 ELSE 2 END AS line FROM part""")
def q_variable_line(spark, d):
    """The first line with the name behind a blank, else the last that has it."""
    text = F.when(F.col("p_size") % 2 == 0, _f("%p_name%1;\n\nint counter = 1;\nuse(counter);")).otherwise(_f("(counter)\n(counter)%p_name%\nx"))
    return _t(spark, d, "part").select("p_partkey", L.variable_line(text, "counter").cast("int").alias("line"))


@query("""SELECT n_name, p_partkey FROM nation JOIN part ON p_brand = 'Brand#' || (n_regionkey + 1)""")
def q_members(spark, d):
    """By equal paths."""
    groups = _t(spark, d, "nation").select("n_name", F.concat(F.lit("Brand#"), (F.col("n_regionkey") + 1).cast("string")).alias("pat"))
    return R.members_by_path(groups, _t(spark, d, "part"), "n_name", "pat", "p_brand").select("n_name", "p_partkey")


@query("""WITH RECURSIVE d AS (SELECT source AS dir, lpad(doc_id::VARCHAR, 12, '0') AS file, n_chars AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
w AS (SELECT dir, file, size, i, size AS total, file AS component FROM d WHERE i = 1 UNION ALL
SELECT d.dir, d.file, d.size, d.i, CASE WHEN total + d.size <= 131072 THEN total + d.size ELSE d.size END, CASE WHEN total + d.size <= 131072 THEN component ELSE d.file END FROM w JOIN d ON d.dir = w.dir AND d.i = w.i + 1)
SELECT dir, file, component, size FROM w""")
def q_capped_pack(spark, d):
    """Documents of a source, chained in order of their ids, packed into modules of at most 131,072 characters."""
    from pyspark.sql import Window

    docs = _t(spark, d, "documents").select(F.col("source").alias("dir"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("file"), F.col("n_chars").alias("size"))
    chain = docs.select("dir", F.col("file").alias("src"), F.lead("file").over(Window.partitionBy("dir").orderBy("file")).alias("dst")).where("dst IS NOT NULL")
    return M.capped_components(docs, chain, 131072)


@query("""SELECT 'src/' || p_partkey || '.c' AS file, 'int' AS value, 'v_' || p_partkey AS name FROM part WHERE p_size % 2 = 1 UNION ALL SELECT 'src/' || p_partkey || '.c', 'long', 'w_' || p_partkey FROM part WHERE p_size % 2 = 0""")
def q_conditions(spark, d):
    """S3: which branch is compiled."""
    text = _f("#define SIZE %p_size%\n#if (SIZE %% 2) == 1 && !defined(NONE)\nint v_%p_partkey%;\n#elif SIZE >= 0\nlong w_%p_partkey%;\n#endif\n".replace("%%", "\x01"))
    files = _t(spark, d, "part").select(_f("src/%p_partkey%.c").alias("path"), F.translate(text, "\x01", "%").alias("text"))
    return cparse.facts(files).where("kind = 'global'").select("file", "value", "name")
