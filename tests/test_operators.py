"""Operators on small tables, properties, and all queries against DuckDB."""

import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from factloom.functions import text as X
from factloom.operators import graph, lines, modules
from factloom.operators import relational as R
from factloom.plans import catalogue, prompts

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def canonical(rows):
    return sorted(tuple("%.9g" % v if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = duck.execute(catalogue.ORACLES[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    expected = [[r[names.index(c)] for c in columns] for r in got.fetchall()]
    assert canonical(df.select(*columns).collect()) == canonical(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def edges_of(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def test_levels_put_callees_first(spark):
    pairs = [("a", "b"), ("b", "c"), ("a", "c"), ("x", "y"), ("y", "x"), ("y", "z"), ("a", "z")]
    level = {r.v: r.level for r in graph.levels(edges_of(spark, pairs)).collect()}
    assert level == {"x": 0, "y": 0, "z": 0, "c": 1, "b": 2, "a": 3}


def test_graph_of_nothing(spark):
    e = edges_of(spark, [])
    assert graph.levels(e).count() == graph.components(e).count() == graph.roots(e).count() == 0
    assert graph.levels(e, spark.createDataFrame([("q",)], "v string")).collect()[0].level == 0


def test_paths_have_no_depth_limit(spark):
    chain = edges_of(spark, [(f"n{i:03}", f"n{i + 1:03}") for i in range(70)])
    start = spark.createDataFrame([("n000",)], "v string")
    assert graph.call_paths(chain, start).agg(F.max("depth")).first()[0] == 70
    assert graph.call_paths(chain, start, 5).agg(F.max("depth")).first()[0] == 5
    assert graph.reachable(chain, start).agg(F.max("depth")).first()[0] == 70
    assert graph.levels(chain).agg(F.max("level")).first()[0] == 70
    assert graph.closure(chain.limit(9)).count() == 45


def test_paths_stop_at_repeats(spark):
    got = graph.call_paths(edges_of(spark, [("a", "b"), ("b", "a"), ("b", "c")]), spark.createDataFrame([("a",)], "v string"))
    assert sorted(r.path for r in got.collect()) == [["a"], ["a", "b"], ["a", "b", "c"]]


@given(st.lists(st.tuples(st.sampled_from("abcdef"), st.sampled_from("abcdef")), max_size=20))
@settings(max_examples=50, deadline=None)
def test_cycles_go(pairs):
    kept = graph.without_cycles([p for p in pairs if p[0] != p[1]])
    assert set(kept) <= set(pairs)
    after = {}
    for a, b in kept:
        after.setdefault(a, []).append(b)

    def reaches(x, y, seen=()):
        return any(n == y or n not in seen and reaches(n, y, (*seen, n)) for n in after.get(x, []))

    assert not any(reaches(x, x) for x in after)


def test_components_of_all_rows(spark, tmp_path):
    rng = random.Random(6)
    tables = {
        "supplier": ("s_suppkey long, s_nationkey int, s_acctbal double", [(i, rng.randrange(6), rng.uniform(-900, 9900)) for i in range(90)]),
        "customer": ("c_custkey long, c_nationkey int", [(i, rng.randrange(25)) for i in range(60)]),
        "orders": ("o_orderkey long, o_custkey long", [(i, rng.randrange(90)) for i in range(150)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    pairs = [(f"{a}{r[0]}", f"{b}{r[1]}") for a, b, name in (("s", "n", "supplier"), ("c", "n", "customer"), ("o", "c", "orders")) for r in tables[name][1]]
    least = {v: v for p in pairs for v in p}
    while any(least[a] != least[b] for a, b in pairs):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    got = {r.v: r.component for r in catalogue.QUERIES["q_components"](spark, str(tmp_path)).collect()}
    assert got == least and len(set(got.values())) > 1


def test_capped_components(spark):
    files = spark.createDataFrame([("d", f"f{i}", s) for i, s in enumerate([50, 60, 10, 500, 5])], "dir string, file string, size long")
    edges = spark.createDataFrame([("d", "f0", "f1"), ("d", "f0", "f2"), ("d", "f2", "f3"), ("d", "f3", "f4")], "dir string, src string, dst string")
    got = {r.file: r.component for r in modules.capped_components(files, edges, 100).collect()}
    assert got == {"f0": "f0", "f2": "f0", "f1": "f1", "f3": "f3", "f4": "f4"}


def test_hot_names_don_t_multiply(spark):
    calls = spark.createDataFrame([(i, "f", f"file{i % 3}") for i in range(50)], "caller int, name string, file string")
    definitions = spark.createDataFrame([("f", f"file{i % 2}", i) for i in range(100)], "n string, f string, k int")
    got = R.resolve(calls, definitions, "caller", "name", "file", "n", "f", "k")
    assert got.count() == 50 and {r.target_key for r in got.where("file = 'file1'").collect()} == {1} and {r.target_key for r in got.where("file = 'file2'").collect()} == {0}


def test_doc_comments(spark):
    text = "\n".join(["int a;", "// one", "// two", "int f();", "", "/* x */", "int g();", "/* y", " z */", "int h();", "int k(); /* same line */", "int m();"])
    one = spark.createDataFrame([(text,)], "t string")
    at = lambda n, *more: one.select(lines.doc_comment_start(lines.comment_lines(F.col("t")), F.lit(n), *more)).first()[0]
    assert [at(n) for n in (4, 7, 10, 11, 12, 1)] == [2, 6, 8, 11, 12, 1]
    raw = F.split("t", "\n", -1)
    assert [at(n, raw) for n in (4, 7, 10)] == [2, 1, 8]
    ranges = spark.createDataFrame([("a.c", 4, 4), ("a.c", 10, 99), ("b.c", 1, 2)], "f string, s int, e int")
    got = lines.documented_slices(ranges, one.select(F.lit("a.c").alias("f"), "t"), "f", "t", "s", "e").orderBy("f", "s").collect()
    assert [r.body for r in got] == ["// one\n// two\nint f();", "/* y\n z */\nint h();\nint k(); /* same line */\nint m();", "// no source for b.c:1"]


def test_text_functions(spark):
    one = spark.createDataFrame([("a{b}",)], "x string")
    get = lambda c: one.select(c).first()[0]
    assert get(X.template("<{x}|{b}|{y}>", x=F.col("x"), b=F.lit("B"))) == "<a{b}|B|{y}>"
    assert get(X.bullets(F.array(F.lit("p"), F.lit("q")))) == "- p\n- q" and get(X.bullets(F.array().cast("array<string>"))) == "none"
    assert get(X.stem(F.lit("a/b.c.h"))) == "b.c" and get(X.dir_name(F.lit("a/b/c"))) == "a/b" and get(X.dir_name(F.lit("c"))) == ""
    assert get(X.section_or_null(F.lit("no heading"), "### A", "\n###")) is None
    assert get(X.macro_text(F.lit("M"), F.lit("(a)"), F.lit("x\ny"))) == "#define M(a) x \\\n    y"
    assert get(lines.strip_block_comments(F.lit("a /* b\nc */ d /* e */"))) == "a \n d "
    assert [r[0] for r in one.select(F.explode(X.all_matches(F.lit('#include "a.h"\n # include <b.h>'), X.INCLUDE_NAMES))).collect()] == ["a.h", "b.h"]


def test_variable_line(spark):
    one = spark.createDataFrame([("x1;\nint x;\nint *x = 0;\nuse(x)",)], "t string")
    assert one.select(lines.variable_line(F.col("t"), "x"), lines.variable_line(F.col("t"), "use"), lines.variable_line(F.col("t"), "zz")).first()[:] == (2, 4, None)


def test_members_and_samples(spark):
    groups = spark.createDataFrame([("m", "lib/a.c")], "module string, path string")
    facts = spark.createDataFrame([("g", "lib/a.c"), ("h", "xlib/a.c.bak")], "name string, at string")
    assert R.members_by_path(groups, facts, "module", "path", "at").count() == 1
    assert R.members_by_path(groups, facts, "module", "path", "at", compat=True).count() == 2
    many = spark.range(100).select(F.lit("k").alias("k"), F.col("id").alias("v"))
    a, b = (sorted(r.v for r in R.sample_k(many.repartition(n), ["k"], "v", 10).collect()) for n in (1, 7))
    assert a == b and len(a) == 10
    assert R.named(spark.createDataFrame([("a",), (" ",), (None,)], "n string"), "n").count() == 1


def test_members_are_distinct_before_they_meet_groups(spark, tmp_path):
    groups = spark.createDataFrame([("m", "a"), ("m", "b"), ("n", "b"), (None, "a"), ("n", None)], "module string, path string")
    facts = spark.createDataFrame([(1, "f", "a"), (1, "f", "b"), (1, "f", "b"), (2, None, "xb"), (3, "g", None), (4, "h", "c"), (5, "i", "ab")], "k long, name string, at string")
    near = R.members_by_path(groups, facts, "module", "path", "at", compat=True, columns=["k", "name"])
    assert sorted(near.collect(), key=str) == sorted([("m", 1, "f"), ("n", 1, "f"), (None, 1, "f"), ("m", 2, None), ("n", 2, None), ("m", 5, "i"), ("n", 5, "i"), (None, 5, "i")], key=str)
    equal = R.members_by_path(groups, facts, "module", "path", "at")
    assert equal.columns == ["module", "k", "name", "at"]
    assert sorted(equal.collect(), key=str) == sorted([("m", 1, "f", "a"), (None, 1, "f", "a"), ("m", 1, "f", "b"), ("n", 1, "f", "b")], key=str)
    for df in (near, equal):
        assert "Aggregate" not in df._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    # One part under two brands of a nation is one row of the query, as in its SQL.
    spark.createDataFrame([("N", 0)], "n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(1, "p", "Brand#1"), (1, "p", "Brand#10"), (2, "q", "Brand#2")], "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    assert catalogue.QUERIES["q_substring_members"](spark, str(tmp_path)).collect() == [("N", 1, "p")]


def test_only_a_batch_of_prompts_is_held(spark):
    class Traced:
        """Answers with the number of long strings that are held, of those made since the first call."""

        def __call__(self, texts):
            import tracemalloc

            if not tracemalloc.is_tracing():
                tracemalloc.start()
            held = sum(20_000 <= t.size < 21_000 for t in tracemalloc.take_snapshot().traces)
            if texts[-1] is None:
                tracemalloc.stop()
            return [str(held)] * len(texts)

    n = 1000
    key = F.when(F.col("id") % 2 == 1, F.col("id") + (1 << 53))
    rows = spark.range(0, n, 1, 1).select(key.alias("key"), F.when(F.col("id") < n - 1, F.concat(F.repeat(F.lit("x"), 20_000), F.col("id"))).alias("prompt"))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "500")
    try:
        got = prompts.complete(rows, Traced()).collect()
    finally:
        spark.conf.set(name, before)
    assert [r.prompt and r.prompt.lstrip("x") for r in got] == [*map(str, range(n - 1)), None]
    assert 0 < max(int(r.response) for r in got) < 100
    assert [r.key for r in got] == [i + (1 << 53) if i % 2 else None for i in range(n)]


def test_prompts_keep_their_other_columns(spark):
    sql = "SELECT * FROM VALUES (1, 'a', timestamp'2024-01-01 00:00:00', date'2024-01-02', 1.5BD, array('x', null), named_struct('y', 1), X'00ff'), (null, null, null, null, null, null, null, null), (3, '', null, null, null, array(), null, X'') AS t(i, prompt, ts, d, n, l, s, b)"
    rows = spark.sql(sql)
    got = prompts.complete(rows, lambda texts: [None if x is None else f"\u200b{x}!\ufeff" for x in texts], batch=2)
    assert got.columns == [*rows.columns, "response"]
    assert sorted(map(str, got.drop("response").collect())) == sorted(map(str, rows.collect()))
    assert {r.prompt: r.response for r in got.collect()} == {"a": "a!", None: None, "": "!"}
    assert prompts.complete(rows.where("i > 5"), prompts.OfflineStub(), workers=2).collect() == []
