"""The fact operators applied to the driver's tables, each with its SQL.

``part`` stands for definitions (few names, many rows), ``lineitem`` for calls, ``documents`` and
``pages`` for source text, ``events`` for transitions, ``nation`` and ``region`` for the module tree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import graph as G
from ..operators import lines as L
from ..operators import modules as M
from ..operators import relational as R
from ..sources import cparse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- joins -------------------------------------------------------------------------------------

_CALLS = "SELECT DISTINCT l_suppkey AS caller, p_name AS name, p_brand AS file FROM lineitem JOIN part ON l_partkey = p_partkey"


def _calls(spark, d):
    part = _t(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("file"))
    return _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("caller"), "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey")).select("caller", "name", "file").distinct()


_RESOLVE = """WITH c AS ({calls}), d AS (SELECT p_name AS n, p_brand AS f, p_partkey AS k FROM part {where}),
r AS (SELECT c.*, d.k, d.f, row_number() OVER (PARTITION BY caller, name, file ORDER BY CASE WHEN d.f = c.file THEN 0 ELSE 1 END, d.k) AS rn FROM c LEFT JOIN d ON c.name = d.n)
SELECT caller, name, file, k AS target_key, f AS target_file, coalesce(k::VARCHAR, 'unknown:' || name) AS target FROM r WHERE rn = 1"""


@query(_RESOLVE.format(calls=_CALLS, where=""))
def q_resolve(spark, d):
    return R.resolve(_calls(spark, d), _t(spark, d, "part"), "caller", "name", "file", "p_name", "p_brand", "p_partkey")


@query(_RESOLVE.format(calls=_CALLS, where="WHERE p_size < 10 AND p_name < 'm'"))
def q_unresolved(spark, d):
    return R.resolve(_calls(spark, d), _t(spark, d, "part").where("p_size < 10 AND p_name < 'm'"), "caller", "name", "file", "p_name", "p_brand", "p_partkey")


@query("""SELECT s_suppkey, s_name, n_name FROM supplier JOIN (SELECT n_nationkey, min(n_name) AS n_name FROM nation GROUP BY 1) ON s_nationkey = n_nationkey""")
def q_lookup(spark, d):
    nation = _t(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return R.lookup(_t(spark, d, "supplier"), nation, ["s_nationkey"], ["n_name"]).select("s_suppkey", "s_name", "n_name")


@query("""SELECT c_custkey, arg_min(o_orderkey, row(o_orderpriority, o_orderkey)) AS o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""")
def q_ranked_probe(spark, d):
    orders = _t(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return R.ranked_probe(_t(spark, d, "customer").select("c_custkey"), orders, ["c_custkey"], "o_orderpriority", "o_orderkey")


@query("""WITH f AS (SELECT c_nationkey AS name FROM customer WHERE c_acctbal > 9000), e AS (SELECT s_suppkey, s_nationkey AS name, s_acctbal < 5000 AS weak FROM supplier)
SELECT * FROM e WHERE NOT weak UNION ALL SELECT * FROM e WHERE weak AND name NOT IN (SELECT name FROM f)""")
def q_weak_override(spark, d):
    defined = _t(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("name"))
    exports = _t(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("name"), (F.col("s_acctbal") < 5000).alias("weak"))
    return R.weak_override(defined, exports, "name", "weak")


@query("""SELECT p_partkey, coalesce(u, '') AS uses FROM part LEFT JOIN (SELECT l_partkey, string_agg(DISTINCT l_suppkey::VARCHAR, ',' ORDER BY l_suppkey::VARCHAR) AS u FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""")
def q_left_uses(spark, d):
    uses = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").cast("string").alias("use"))
    return R.with_uses(_t(spark, d, "part").select("p_partkey"), uses, "p_partkey", "use").select("p_partkey", F.array_join("uses", ",").alias("uses"))


@query("""SELECT DISTINCT p_brand AS name, l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 45
UNION SELECT p_type, l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity < 5""")
def q_typed_uses(spark, d):
    part, line = _t(spark, d, "part"), _t(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    direct = line.where("l_quantity > 45").join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("name"), "l_suppkey")
    through = line.where("l_quantity < 5").select(F.col("l_partkey").cast("string").alias("name"), "l_suppkey")
    return R.typed_uses(direct, part.select(F.col("p_partkey").cast("string").alias("name"), "p_type"), through, "name", "p_type", ["l_suppkey"])


@query("""SELECT DISTINCT coalesce(r_name, n_name) AS name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT n_name AS a, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name < 'B') ON a = n_name""")
def q_alias_fold(spark, d):
    nation, region = _t(spark, d, "nation"), _t(spark, d, "region")
    uses = _t(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("name"), "c_mktsegment")
    aliases = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("alias"), F.col("r_name").alias("target"))
    return R.fold_aliases(uses, aliases, region.where("r_name < 'B'").select(F.col("r_name").alias("name")), "name", "alias", "target")


@query("""SELECT DISTINCT a.n_regionkey AS src_group, b.n_regionkey AS dst_group FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON s_suppkey = l_suppkey JOIN nation a ON a.n_nationkey = c_nationkey JOIN nation b ON b.n_nationkey = s_nationkey WHERE a.n_regionkey <> b.n_regionkey""")
def q_module_deps(spark, d):
    sold = _t(spark, d, "lineitem").select("l_orderkey", "l_suppkey").join(_t(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    edges = sold.join(_t(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(_t(spark, d, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return R.group_edges(edges, _t(spark, d, "nation"), "c_nationkey", "s_nationkey", "n_nationkey", "n_regionkey")


@query("""SELECT DISTINCT n_name, p_partkey, p_name FROM part JOIN (SELECT n_name, 'Brand#' || (n_regionkey + 1)::VARCHAR AS pat FROM nation) ON instr(p_brand, pat) > 0""")
def q_substring_members(spark, d):
    groups = _t(spark, d, "nation").select("n_name", F.concat(F.lit("Brand#"), (F.col("n_regionkey") + 1).cast("string")).alias("pat"))
    return R.members_by_path(groups, _t(spark, d, "part"), "n_name", "pat", "p_brand", compat=True, columns=["p_partkey", "p_name"])


# --- aggregates --------------------------------------------------------------------------------


@query("""SELECT src, dst, count(*) AS n FROM (SELECT event_type AS src, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dst FROM events) WHERE dst IS NOT NULL GROUP BY ALL""")
def q_edges_transitions(spark, d):
    from pyspark.sql import Window

    following = F.lead("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return _t(spark, d, "events").select(F.col("event_type").alias("src"), following.alias("dst")).where("dst IS NOT NULL").groupBy("src", "dst").agg(F.count("*").alias("n"))


@query("""SELECT l_partkey, string_agg(DISTINCT l_suppkey::VARCHAR, ',' ORDER BY l_suppkey::VARCHAR) AS callers FROM lineitem GROUP BY 1""")
def q_callers(spark, d):
    edges = _t(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("src"), "l_partkey")
    return R.callers(edges, "src", "l_partkey").select("l_partkey", F.array_join("callers", ",").alias("callers"))


@query("""SELECT v, count(DISTINCT l_suppkey) AS in_degree FROM (SELECT p_partkey AS v FROM part UNION SELECT l_partkey FROM lineitem) LEFT JOIN lineitem ON l_partkey = v GROUP BY v""")
def q_indegree(spark, d):
    return R.in_degree(_t(spark, d, "part").select(F.col("p_partkey").alias("v")), _t(spark, d, "lineitem").select("l_suppkey", "l_partkey"), "v", "l_partkey")


@query("""SELECT l_partkey, arg_max(l_suppkey, row(l_shipdate, l_orderkey, l_linenumber, l_suppkey)) AS l_suppkey FROM lineitem GROUP BY 1""")
def q_last_wins(spark, d):
    return R.last_wins(_t(spark, d, "lineitem"), ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"], ["l_suppkey"])


@query("""SELECT o_custkey, arg_max(o_orderkey, row((o_orderpriority LIKE '1%')::INT, o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1""")
def q_priority_upsert(spark, d):
    return R.priority_wins(_t(spark, d, "orders"), ["o_custkey"], F.startswith(F.col("o_orderpriority"), F.lit("1")), ["o_orderdate", "o_orderkey"], ["o_orderkey"])


@query("""SELECT md5(text) AS h, min(doc_id) AS doc_id FROM documents GROUP BY 1""")
def q_first_wins(spark, d):
    docs = _t(spark, d, "documents").select(F.md5("text").alias("h"), "doc_id")
    return R.first_by(docs, ["h"], ["doc_id"]).select("h", "doc_id")


@query("""SELECT p_brand, bool_or(regexp_matches(lower(p_name), 'main|init|config|setup|start|begin|e')) AS init FROM part GROUP BY 1""")
def q_init_flag(spark, d):
    return R.any_of(_t(spark, d, "part"), ["p_brand"], F.lower("p_name").rlike("main|init|config|setup|start|begin|e"), "init")


@query("""WITH e AS (SELECT p_brand, substr(p_type, 1, 1) AS k, min(p_type) AS a, max(p_type) AS b FROM part GROUP BY ALL),
p AS (SELECT p_brand, k, a, max(i) AS n FROM (SELECT *, unnest(range(0, least(length(a), length(b)) + 1)) AS i FROM e) WHERE substr(a, 1, i) = substr(b, 1, i) GROUP BY ALL)
SELECT p_brand, k, substr(a, 1, n) AS prefix FROM p""")
def q_lcp(spark, d):
    return R.common_prefix(_t(spark, d, "part").withColumn("k", F.substring("p_type", 1, 1)), ["p_brand", "k"], "p_type")


@query("""SELECT p_name, arg_min(p_type, row((NOT regexp_matches(lower(p_type), 'loop|task|process|handle|run'))::INT, p_partkey)) AS main_loop FROM part GROUP BY 1""")
def q_main_loop(spark, d):
    return R.main_loop(_t(spark, d, "part"), "p_name", "p_type", "p_partkey")


# --- graphs ------------------------------------------------------------------------------------


def _thirds(spark, d):
    return _t(spark, d, "part").where("p_partkey > 0").select(F.col("p_partkey").alias("src"), F.floor(F.col("p_partkey") / 3).cast("long").alias("dst"))


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS src, p_partkey // 3 AS dst FROM part WHERE p_partkey > 0),
w AS (SELECT DISTINCT src AS v, 0 AS n FROM e WHERE src NOT IN (SELECT dst FROM e) UNION ALL SELECT dst, n + 1 FROM w JOIN e ON v = src),
m AS (SELECT v, max(n) AS n FROM w GROUP BY v)
SELECT v, ((SELECT max(n) FROM m) - n)::INT AS level FROM m""")
def q_levels_dag(spark, d):
    return G.levels(_thirds(spark, d))


@query("""WITH RECURSIVE t AS (SELECT DISTINCT event_type AS src, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dst FROM events),
e AS (SELECT src, dst FROM t WHERE dst IS NOT NULL UNION SELECT 'root', min(src) FROM t UNION SELECT 'alone', 'root'),
c AS (SELECT src, dst FROM e UNION SELECT c.src, e.dst FROM c JOIN e ON c.dst = e.src),
cyc AS (SELECT DISTINCT src AS v FROM c WHERE src = dst)
SELECT v, 0 AS level FROM cyc UNION ALL SELECT 'root', 1 UNION ALL SELECT 'alone', 2""")
def q_levels_cyclic(spark, d):
    seen = q_edges_transitions(spark, d).select("src", "dst")
    extra = seen.agg(F.lit("root").alias("src"), F.min("src").alias("dst")).union(spark.range(1).select(F.lit("alone"), F.lit("root")))
    return G.levels(seen.union(extra))


@query("""WITH RECURSIVE e AS (SELECT 'r' || r_regionkey AS src, 'n' || n_nationkey AS dst FROM region JOIN nation ON n_regionkey = r_regionkey
UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders),
w AS (SELECT 'r0' AS v, 0 AS depth UNION SELECT dst, depth + 1 FROM w JOIN e ON v = src)
SELECT v, min(depth)::INT AS depth FROM w GROUP BY v""")
def q_reach(spark, d):
    k = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = _t(spark, d, "nation").select(k("r", "n_regionkey").alias("src"), k("n", "n_nationkey").alias("dst"))
    edges = edges.union(_t(spark, d, "customer").select(k("n", "c_nationkey"), k("c", "c_custkey"))).union(_t(spark, d, "orders").select(k("c", "o_custkey"), k("o", "o_orderkey")))
    return G.reachable(edges, spark.range(1).select(F.lit("r0").alias("v")))


@query("""SELECT p_partkey AS v FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)""")
def q_uncalled(spark, d):
    called = _t(spark, d, "lineitem").where("l_quantity > 48").select(F.col("l_partkey").alias("v"))
    return R.subtract_keys(_t(spark, d, "part").select(F.col("p_partkey").alias("v")), called, ["v"])


@query("""WITH e AS (SELECT p_partkey AS src, p_partkey // 3 AS dst FROM part WHERE p_partkey > 0) SELECT DISTINCT src AS v FROM e WHERE src NOT IN (SELECT dst FROM e)""")
def q_roots(spark, d):
    return G.roots(_thirds(spark, d))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT 'r' || n_regionkey AS src, 'n' || n_nationkey AS dst FROM nation UNION SELECT DISTINCT 'n' || s_nationkey, 'r' || (s_nationkey % 5)::INT FROM supplier),
w AS (SELECT ['r0'] AS path, 'r0' AS last, 0 AS depth UNION ALL SELECT list_append(path, dst), dst, depth + 1 FROM w JOIN e ON last = src WHERE NOT list_contains(path, dst))
SELECT array_to_string(path, '>') AS path, depth FROM w""")
def q_call_paths(spark, d):
    k = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    edges = _t(spark, d, "nation").select(k("r", F.col("n_regionkey")).alias("src"), k("n", F.col("n_nationkey")).alias("dst"))
    edges = edges.union(_t(spark, d, "supplier").select(k("n", F.col("s_nationkey")), k("r", F.col("s_nationkey") % 5)))
    return G.call_paths(edges, spark.range(1).select(F.lit("r0").alias("v"))).select(F.array_join("path", ">").alias("path"), "depth")


@query("""WITH RECURSIVE e AS (SELECT 's' || s_suppkey AS a, 'n' || s_nationkey AS b FROM supplier UNION SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders),
s AS (SELECT a AS x, b AS y FROM e UNION ALL SELECT b, a FROM e),
w(v, r) USING KEY (v) AS (SELECT DISTINCT x, x FROM s UNION SELECT s.y, min(w.r) FROM w JOIN s ON w.v = s.x JOIN recurring.w AS c ON c.v = s.y WHERE w.r < c.r GROUP BY s.y)
SELECT v, r AS component FROM w""")
def q_components(spark, d):
    """Suppliers and customers with their nations, orders with their customers, all rows under their own keys."""
    k = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = _t(spark, d, "supplier").select(k("s", "s_suppkey").alias("src"), k("n", "s_nationkey").alias("dst"))
    edges = edges.union(_t(spark, d, "customer").select(k("c", "c_custkey"), k("n", "c_nationkey"))).union(_t(spark, d, "orders").select(k("o", "o_orderkey"), k("c", "o_custkey")))
    return G.components(edges)


# --- lines and text ----------------------------------------------------------------------------

_LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1)::INT AS line_no FROM documents)"


def _lines(spark, d):
    return L.source_lines(_t(spark, d, "documents"), "doc_id", "text")


@query(f"WITH {_LINES} SELECT doc_id, line_no, text FROM lines")
def q_lines(spark, d):
    return _lines(spark, d)


@query("""SELECT doc_id, array_to_string(string_split(text, chr(10))[2:5], chr(10)) AS body FROM documents""")
def q_slice(spark, d):
    return _t(spark, d, "documents").select("doc_id", L.slice_lines(F.col("text"), 2, 5).alias("body"))


@query(f"WITH {_LINES} SELECT doc_id, line_no, last_value(CASE WHEN length(text) > 40 THEN trim(text) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM lines")
def q_prev_effective(spark, d):
    return L.previous_effective(_lines(spark, d), "doc_id", F.char_length("text") > 40).select("doc_id", "line_no", "previous")


@query(f"""WITH {_LINES}, w AS (SELECT *, list(text) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 2 PRECEDING AND 9 FOLLOWING) AS l FROM lines)
SELECT doc_id, line_no, array_to_string(l, chr(10)) AS snippet FROM w WHERE contains(text, 'license')""")
def q_context(spark, d):
    return L.context(_lines(spark, d), "doc_id", F.contains("text", F.lit("license")), 2, 9).select("doc_id", "line_no", "snippet")


@query("""WITH a AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), b AS (SELECT *, list_position(list_transform(l, lambda x: starts_with(x, 'The ')), true) AS pos FROM a)
SELECT doc_id, CASE WHEN pos > 0 THEN pos::BIGINT END AS line_no, array_to_string(CASE WHEN pos > 0 THEN l[greatest(pos - 20, 1):pos + 100] ELSE l[1:50] END, chr(10)) AS snippet FROM b""")
def q_first_context(spark, d):
    return L.first_context(_t(spark, d, "documents"), "doc_id", "text", "The ", 20, 100, 50)


@query(f"""WITH {_LINES}, a AS (SELECT *, sum(CASE WHEN coalesce(prev, true) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS g
FROM (SELECT *, lag(ends_with(text, '.')) OVER (PARTITION BY doc_id ORDER BY line_no) AS prev FROM lines))
SELECT doc_id, min(line_no) AS start, count(*) AS line_count, string_agg(text, chr(10) ORDER BY line_no) AS text FROM a GROUP BY doc_id, g""")
def q_continuation(spark, d):
    return L.continued(_lines(spark, d), "doc_id", ~F.endswith("text", F.lit(".")))


@query("""SELECT page_id, CASE WHEN instr(html, '<article>') > 0 THEN regexp_replace(string_split(substr(html, instr(html, '<article>') + 9), '</article>')[1], '^\\s+|\\s+$', '', 'g') ELSE html END AS body FROM pages""")
def q_section(spark, d):
    return _t(spark, d, "pages").select("page_id", X.section("html", "<article>", "</article>").alias("body"))


@query("""SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages""")
def q_href(spark, d):
    return _t(spark, d, "pages").select("page_id", F.explode(X.all_matches("html", 'href="([^"]+)"')).alias("href"))


@query("""SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace('const struct ' || p_type || ' const * *& ', '\\bconst\\b', ' ', 'g'), '[\\s*&]+$', ''), '\\s+', ' ', 'g')) AS bare FROM part""")
def q_norm_type(spark, d):
    return _t(spark, d, "part").select("p_partkey", X.bare_type(F.concat(F.lit("const struct "), "p_type", F.lit(" const * *& "))).alias("bare"))


@query("""SELECT doc_id, source FROM documents WHERE NOT (contains(source, '1') OR contains(source, 'c7'))""")
def q_ignore(spark, d):
    return R.ignore_paths(_t(spark, d, "documents").select("doc_id", "source"), "source", ["1", "c7"])


@query("""SELECT p_partkey, p_name FROM part WHERE NOT (starts_with(p_name, 'a') OR starts_with(p_name, 'bl') OR p_name = 'green')""")
def q_builtin_filter(spark, d):
    return R.drop_prefixed(_t(spark, d, "part").select("p_partkey", "p_name"), "p_name", ["a", "bl"], ["green"])


@query("""WITH s AS (SELECT url, string_split(regexp_replace(url, '^[a-z]+://', ''), '/') AS p FROM pages), t AS (SELECT DISTINCT array_to_string(p[1:i], '/') AS path, i::INT AS depth FROM (SELECT p, unnest(range(1, least(len(p), 3) + 1)) AS i FROM s))
SELECT path, depth, split_part(path, '/', depth) AS name FROM t""")
def q_url_tree(spark, d):
    return M.path_tree(_t(spark, d, "pages").select(F.regexp_replace("url", "^[a-z]+://", "").alias("path")), "path", 3).select("path", "depth", "name")


@query("""SELECT l_partkey, l_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY md5('s1' || l_orderkey::VARCHAR), l_orderkey) AS r FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem)) WHERE r <= 10""")
def q_sample_k(spark, d):
    return R.sample_k(_t(spark, d, "lineitem").select("l_partkey", "l_orderkey").distinct(), ["l_partkey"], "l_orderkey", 10)


@query("""SELECT doc_id, 'Document ' || doc_id || ' from ' || source || ': quality ' || coalesce(quality::VARCHAR, 'unknown') || chr(10) || text AS prompt FROM documents LEFT JOIN labels USING (doc_id)""")
def q_prompt(spark, d):
    rows = _t(spark, d, "documents").join(_t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    tpl = "Document {id} from {source}: quality {quality}\n{text}"
    return rows.select("doc_id", X.template(tpl, id=F.col("doc_id"), source=F.col("source"), quality=X.or_default(F.col("quality").cast("string"), "unknown"), text=F.col("text")).alias("prompt"))


@query("""SELECT conv_id, turn, '### Q: ' || text || chr(10) || '### A: ' || answer || chr(10) || '---' AS sample FROM (SELECT *, lead(text) OVER w AS answer, lead(role) OVER w AS next FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)) WHERE role = 'user' AND next = 'assistant'""")
def q_qa(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = _t(spark, d, "conversations").withColumns({"answer": F.lead("text").over(w), "next": F.lead("role").over(w)})
    return rows.where("role = 'user' AND next = 'assistant'").select("conv_id", "turn", X.question_answer("text", "answer").alias("sample"))


@query("""SELECT doc_id, md5(text) AS h FROM documents""")
def q_trim_zw(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.md5(X.trim_invisible(F.concat(F.lit("﻿​"), "text", F.lit("⁠")))).alias("h"))


@query("""SELECT p_partkey, 'P' || p_partkey AS name, '(a, b)' AS params, 'a +' || chr(10) || p_size || ' * b' AS body, 'MAX_a__b_' AS safe FROM part""")
def q_macro_def(spark, d):
    src = F.concat(F.lit("#define P"), "p_partkey", F.lit("(a, b) a + \\\n    "), "p_size", F.lit(" * b"))
    return _t(spark, d, "part").select("p_partkey", X.macro_name(src).alias("name"), X.macro_params(src).alias("params"), X.macro_body(src).alias("body"), X.file_safe(F.lit("MAX(a, b)")).alias("safe"))


@query("""SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_done_anti(spark, d):
    return R.not_done(_t(spark, d, "documents").select("doc_id", "source"), _t(spark, d, "labels"), ["doc_id"])


@query("""SELECT source, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids FROM documents GROUP BY 1""")
def q_concat(spark, d):
    return L.concatenated(_t(spark, d, "documents"), ["source"], ["doc_id"], F.col("doc_id").cast("string"), ",", "ids")


@query("""SELECT p_brand, count(*) AS n, sum(p_size)::BIGINT AS size FROM part GROUP BY 1 ORDER BY 1""")
def q_group_by_dir(spark, d):
    return M.by_directory(_t(spark, d, "part").select(F.concat("p_brand", F.lit("/"), F.col("p_partkey").cast("string")).alias("path"), "p_size"), "path", "p_size").withColumnRenamed("dir", "p_brand")


# --- the parser, on C text made from table rows ---------------------------------------------------


@query("""SELECT DISTINCT 'o_' || o_orderkey AS caller, 'c_' || o_custkey AS callee FROM orders""")
def q_parse_calls(spark, d):
    body = F.concat(F.lit("/* f() */\nint o_"), "o_orderkey", F.lit("(void)\n{\n    // g();\n    if (1) { return c_"), "o_custkey", F.lit('("h()"); }\n}\n'))
    files = _t(spark, d, "orders").select(F.concat(F.lit("src/"), "o_orderkey", F.lit(".c")).alias("path"), body.alias("text"))
    return cparse.facts(files).where("kind = 'call'").select(F.col("owner").alias("caller"), F.col("name").alias("callee")).distinct()


@query("""SELECT 'src/' || p_partkey || '.h' AS file, 'M_' || p_partkey AS name, '(x)' AS params, '((x) + ' || p_size || ')' AS content FROM part""")
def q_parse_macros(spark, d):
    body = F.concat(F.lit("#ifndef H_"), "p_partkey", F.lit("_H\n#define H_"), "p_partkey", F.lit("_H\n#define M_"), "p_partkey", F.lit("(x) ((x) + \\\n   "), "p_size", F.lit(")\n#endif\n"))
    files = _t(spark, d, "part").select(F.concat(F.lit("src/"), "p_partkey", F.lit(".h")).alias("path"), body.alias("text"))
    return cparse.facts(files).where("kind = 'macro'").select("file", "name", F.col("extra").alias("params"), F.regexp_replace("value", r"\s+", " ").alias("content"))


@query("""SELECT 'src/' || s_suppkey || '.c' AS file, 'g_' || s_suppkey AS name, 'unsigned int' AS type_text, s_nationkey % 2 = 0 AS is_definition FROM supplier""")
def q_parse_globals(spark, d):
    body = F.concat(F.when(F.col("s_nationkey") % 2 == 0, "static ").otherwise("extern "), F.lit("unsigned int g_"), "s_suppkey", F.when(F.col("s_nationkey") % 2 == 0, " = 3;\n").otherwise(";\n"))
    files = _t(spark, d, "supplier").select(F.concat(F.lit("src/"), "s_suppkey", F.lit(".c")).alias("path"), body.alias("text"))
    return cparse.facts(files).where("kind = 'global'").select("file", "name", F.col("value").alias("type_text"), (F.col("extra") == "definition").alias("is_definition"))


@query("""SELECT doc_id, 'stub:' || md5(text) AS response FROM documents""")
def q_complete_stub(spark, d):
    from . import prompts

    return prompts.complete(_t(spark, d, "documents").select("doc_id", F.col("text").alias("prompt")), prompts.OfflineStub()).select("doc_id", "response")
