"""Joins, filters and aggregates of the fact model; column names are arguments everywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in a total order: first-match joins, limit 1, first-wins."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def resolve(calls: DataFrame, definitions: DataFrame, caller: str, name: str, file: str, def_name: str, def_file: str, def_key: str) -> DataFrame:
    """Callee resolution (J1): same file first, else the smallest key, else ``unknown:<name>``.

    Only what decides is joined: the best definition per (name, file) and the best per name, both summed
    before the join, so a name with many definitions never multiplies the calls.
    """
    local = definitions.groupBy(F.col(def_name).alias("_n"), F.col(def_file).alias("_f")).agg(F.min(def_key).alias("_local"))
    anywhere = definitions.groupBy(F.col(def_name).alias("_m")).agg(F.min_by(F.struct(F.col(def_key).alias("key"), F.col(def_file).alias("file")), F.struct(F.col(def_key), F.col(def_file))).alias("_any"))
    rows = calls.join(local, (F.col(name) == F.col("_n")) & (F.col(file) == F.col("_f")), "left")
    rows = rows.join(anywhere, F.col(name) == F.col("_m"), "left")
    key = F.coalesce(F.col("_local"), F.col("_any.key"))
    found_in = F.when(F.col("_local").isNotNull(), F.col(file)).otherwise(F.col("_any.file"))
    target = F.coalesce(key.cast("string"), F.concat(F.lit("unknown:"), F.col(name)))
    return rows.select(caller, name, file, key.alias("target_key"), found_in.alias("target_file"), target.alias("target"))


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str], order: Sequence[Column | str], how: str = "inner") -> DataFrame:
    """Join with the first matching row only."""
    return left.join(first_by(right, on, order), list(on), how)


def ranked_probe(wanted: DataFrame, candidates: DataFrame, on: Sequence[str], rank: str, value: str) -> DataFrame:
    """Ordered probe (J5): of the matching candidates the one of the smallest rank, null without any."""
    best = candidates.groupBy(*on).agg(F.min_by(value, F.struct(rank, value)).alias(value))
    return wanted.join(best, list(on), "left")


def weak_override(functions: DataFrame, exports: DataFrame, name: str, weak: str) -> DataFrame:
    """Weak symbols (J6): strong exports are always added, weak ones unless the name is defined."""
    strong = exports.where(~F.col(weak))
    return strong.unionByName(exports.where(F.col(weak)).join(functions.select(name).distinct(), name, "left_anti"))


def with_uses(facts: DataFrame, uses: DataFrame, key: str, use: str, out: str = "uses") -> DataFrame:
    """Facts with their sorted distinct uses, an empty array by default."""
    listed = uses.groupBy(key).agg(F.array_sort(F.collect_set(use)).alias(out))
    return facts.join(listed, key, "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def typed_uses(type_uses: DataFrame, globals_: DataFrame, global_uses: DataFrame, name: str, type_text: str, use: Sequence[str]) -> DataFrame:
    """Users of a global count as users of its type, by exact spelling."""
    through = global_uses.join(globals_.select(name, type_text).distinct(), name).select(F.col(type_text).alias(name), *use)
    return type_uses.select(name, *use).union(through).distinct()


def members_by_path(groups: DataFrame, facts: DataFrame, group: str, path: str, defined_in: str, compat: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """Facts of a group's files (J9, S26); ``compat`` matches a path as a substring, as a nested loop.

    columns: those of the facts that are kept, all by default.  Groups meet the distinct sets of files
    that facts have, so a fact is made distinct once, before it is repeated for each of its groups.
    """
    kept = list(facts.columns if columns is None else columns)
    files = groups.select(group, F.col(path).alias("_path")).distinct()
    if defined_in in kept:
        keyed = facts.select(*kept).repartition(*kept).distinct().withColumn("_files", F.array(defined_in))
        sets = facts.select(F.array(defined_in).alias("_files")).distinct()
    else:
        keyed = facts.select(*kept, defined_in).repartition(*kept).groupBy(*kept).agg(F.array_sort(F.collect_set(defined_in)).alias("_files"))
        sets = keyed.select("_files").distinct()
    matches = F.instr(F.col("_file"), F.col("_path")) > 0 if compat else F.col("_file") == F.col("_path")
    found = sets.select("_files", F.explode("_files").alias("_file")).join(files, matches).select(group, "_files").distinct()
    # Facts stream past the sets' groups; else a small table of facts would be the one to be broadcast.
    return keyed.join(found.hint("shuffle_hash"), "_files").select(group, *kept)


def fold_aliases(uses: DataFrame, aliases: DataFrame, known: DataFrame, name: str, alias: str, target: str) -> DataFrame:
    """Uses under an alias move to the known underlying name."""
    real = aliases.join(known.select(F.col(name).alias("_known")).distinct(), F.col(target) == F.col("_known"), "left_semi")
    real = real.groupBy(F.col(alias).alias("_alias")).agg(F.min(target).alias("_target"))
    rest = [c for c in uses.columns if c != name]
    return uses.join(real, F.col(name) == F.col("_alias"), "left").select(F.coalesce("_target", name).alias(name), *rest).distinct()


def group_edges(edges: DataFrame, members: DataFrame, src: str, dst: str, member: str, group: str) -> DataFrame:
    """Edges rolled up to their ends' groups without loops."""
    side = lambda end, out: members.select(F.col(member).alias(end), F.col(group).alias(out))
    rolled = edges.select(src, dst).distinct().join(side(src, "src_group"), src).join(side(dst, "dst_group"), dst)
    return rolled.where("src_group <> dst_group").select("src_group", "dst_group").distinct()


def callers(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Reverse adjacency."""
    return edges.groupBy(dst).agg(F.array_sort(F.collect_set(src)).alias("callers"))


def in_degree(vertices: DataFrame, edges: DataFrame, vertex: str, dst: str) -> DataFrame:
    """Distinct incoming edges of every vertex, 0 included (A10)."""
    counts = edges.distinct().groupBy(F.col(dst).alias(vertex)).agg(F.count("*").alias("in_degree"))
    every = vertices.select(vertex).union(edges.select(dst)).distinct()
    return every.join(counts, vertex, "left").withColumn("in_degree", F.coalesce("in_degree", F.lit(0)))


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Upsert (A5): per key the values of the last row; one hash aggregation, no sort."""
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("_v")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


def priority_wins(df: DataFrame, keys: Sequence[str], preferred: Column, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Upsert where preferred rows beat later ones."""
    return last_wins(df.withColumn("_p", preferred.cast("int")), keys, ["_p", *order], values)


def any_of(df: DataFrame, keys: Sequence[str], condition: Column, out: str) -> DataFrame:
    """Existential aggregate."""
    return df.groupBy(*keys).agg(F.bool_or(F.coalesce(condition, F.lit(False))).alias(out))


def common_prefix(df: DataFrame, keys: Sequence[str], name: str, out: str = "prefix") -> DataFrame:
    """Longest common prefix per group (A14): that of its smallest and its largest name."""
    ends = df.groupBy(*keys).agg(F.min(name).alias("_a"), F.max(name).alias("_b"))
    n = F.least(F.char_length("_a"), F.char_length("_b"))
    places = F.filter(F.sequence(F.lit(0), n), lambda i: F.substring("_a", F.lit(1), i) == F.substring("_b", F.lit(1), i))
    return ends.select(*keys, F.substring("_a", F.lit(1), F.array_max(places)).alias(out))


def sample_k(df: DataFrame, keys: Sequence[str], value: str, k: int, seed: str = "s1") -> DataFrame:
    """k rows per key by a seeded hash (L3): the same rows on every run and partitioning."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.md5(F.concat(F.lit(seed), F.col(value).cast("string"))), value))).where(F.col("_r") <= k).drop("_r")


def ignore_paths(df: DataFrame, path: str, ignored: Sequence[str]) -> DataFrame:
    """Drop rows whose path contains any of the strings (P4); a null path stays."""
    hit = F.lit(False)
    for x in ignored:
        hit = hit | F.coalesce(F.contains(F.col(path), F.lit(x)), F.lit(False))
    return df.where(~hit)


def drop_prefixed(df: DataFrame, name: str, prefixes: Sequence[str], exact: Sequence[str] = ()) -> DataFrame:
    """Drop built-in names (P3): one test per name, evaluated in the scan's stage."""
    hit = F.col(name).isin(*exact) if exact else F.lit(False)
    for p in prefixes:
        hit = hit | F.startswith(F.col(name), F.lit(p))
    return df.where(~F.coalesce(hit, F.lit(False)))


def not_done(df: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Skip what exists already."""
    return df.join(done.select(*on).distinct(), list(on), "left_anti")


def subtract_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Set difference on keys."""
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def named(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose key columns are neither null nor blank."""
    for c in columns:
        df = df.where(F.col(c).isNotNull() & (F.trim(c) != ""))
    return df


def definitions_only(df: DataFrame, flag: str = "is_definition") -> DataFrame:
    """Declarations vanish."""
    return df.where(F.col(flag))


def main_loop(calls: DataFrame, key: str, callee: str, order: str) -> DataFrame:
    """Per caller the first callee that looks like a loop, else the first."""
    looks = F.lower(callee).rlike("loop|task|process|handle|run")
    return calls.groupBy(key).agg(F.min_by(callee, F.struct((~looks).cast("int"), order)).alias("main_loop"))
