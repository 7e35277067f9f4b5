"""Secret scans with DataFrame functions only: fixed patterns, and a corpus-wide ownership frequency.

Base kinds are found by pattern alone.  Besides, every long token of letters and digits is a
candidate; candidates are counted over the corpus by distinct owners.  One that a single owner
holds, in however many repositories, looks live and is added to the spans as ``owned``; one that
EXAMPLE_OWNERS or more hold is a copied example; any other is shared, and counted as such.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A maximal run that is long enough is what a scan for any run keeps after the short ones are dropped.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ASSIGN_LENGTH = 8
#: From so many owners on a value counts as a copied example.
EXAMPLE_OWNERS = 3
KINDS = ("assign", "access", "hex", "owned")

_BLOCK = 256
#: Characters that are looked at together when texts are masked.
_CHUNK = 4096
_SPAN = "array<struct<start:bigint,rank:int,end:bigint,value:string>>"


def _found(text: Column, pattern: str, rank: int, values: Column | None = None) -> Column:
    """Spans of all matches, from the lengths of the matches and of the pieces between them.

    Arrays grow by copying, so matches are taken in blocks: first each block's length, then its spans.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pair = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("hit"), (matches if values is None else values).alias("value"))
    # The last piece has no match after it.
    pair = F.filter(pair, lambda x: x["hit"].isNotNull())
    pair = F.transform(pair, lambda x: F.struct(F.char_length(x["gap"]).cast("bigint").alias("gap"), F.char_length(x["hit"]).cast("bigint").alias("hit"), x["value"].alias("value")))

    def spans_of(all_: Column) -> Column:
        cuts = F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(_BLOCK))
        blocks = F.transform(cuts, lambda i: F.slice(all_, i, _BLOCK))
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda n, x: n + x["gap"] + x["hit"]))
        starts = F.aggregate(totals, F.array(F.lit(0).cast("bigint")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.flatten(F.zip_with(blocks, F.slice(starts, F.lit(1), F.size(blocks)), block))

    def block(some: Column, at: Column) -> Column:
        def add(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["gap"]
            end = begin + x["hit"]
            span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), x["value"].alias("value"))
            return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

        return F.aggregate(some, F.struct(at.alias("at"), F.array().cast(_SPAN).alias("spans")), add, lambda acc: acc["spans"])

    # A lambda over the one array, so that it is computed once.
    spans = F.flatten(F.transform(F.array(pair), spans_of))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository_col: str = "doc_id", owner_col: str = "source", keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """Spans of every document: ``base`` (the three fixed kinds) and ``spans`` (those and ``owned``).

    Null and empty texts have no spans.  Rows are told apart by position, so repeated rows and null
    ids each get their own result row.  A null repository or owner counts as one value of its own.
    A candidate that overlaps a base span isn't added.  ``n_live``, ``n_shared`` and ``n_example`` count
    the spans of each verdict, and ``repositories`` is the largest number of repositories that hold one
    of the live values.  ``keep_columns`` pass through as ``_k_<name>``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = F.filter(_found(text, ASSIGN, 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))), lambda s: F.char_length(s["value"]) >= ASSIGN_LENGTH)
    mixed = F.filter(_found(text, CANDIDATE, 3), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    found = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(repository_col).cast("string"), F.lit("\0")).alias("_repository"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("\0")).alias("_owner"),
        F.concat(assign, _found(text, ACCESS, 1), _found(text, HEX, 2)).alias("base"),
        mixed.alias("mixed"),
        *[F.col(c).alias(f"_k_{c}") for c in keep_columns],
    )
    # Values are needed as hashes only; written once, so that the row numbers hold if a task is run again.
    hashed = lambda name: F.transform(name, lambda s: s.withField("value", F.md5(s["value"])))
    found = written(found.withColumns({"base": hashed("base"), "mixed": hashed("mixed"), "_row": F.monotonically_increasing_id()}), "found")

    values = found.select("_row", "_repository", "_owner", F.explode(F.concat("base", "mixed")).alias("s")).select("_row", "_repository", "_owner", "s.*")
    # A candidate meets a base span if one that begins no later ends behind its start, or the next one begins before its end.
    fixed = lambda c: F.when(F.col("rank") < 3, F.col(c))
    upto = lambda *order: Window.partitionBy("_row").orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumns({"_reach": F.max(fixed("end")).over(upto("start")), "_next": F.min(fixed("start")).over(upto(F.desc("start")))})
    meets = F.coalesce(F.col("_reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("_next") < F.col("end"), F.lit(False))
    values = written(values.where((F.col("rank") < 3) | ~meets).drop("_reach", "_next"), "values")
    # Distinct step by step: each step is summed before its shuffle.  The join back meets one row per value, so
    # the adaptive skew join can split the rows of a widely copied one.
    frequency = (
        values.groupBy("value", "_owner", "_repository").agg(F.count("*").alias("n"))
        .groupBy("value", "_owner").agg(F.count("*").alias("n"))
        .groupBy("value").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners"))
    )
    live = F.col("owners") == 1
    judged = values.join(frequency, "value").groupBy("_row").agg(
        F.array_sort(F.collect_list(F.when(live & (F.col("rank") == 3), F.struct("start", "rank", "end")))).alias("added"),
        F.count(F.when(F.col("owners") >= EXAMPLE_OWNERS, 1)).alias("n_example"),
        F.count(F.when(live, 1)).alias("n_live"),
        F.count(F.when(~live & (F.col("owners") < EXAMPLE_OWNERS), 1)).alias("n_shared"),
        F.max(F.when(live, F.col("repositories"))).alias("repositories"),
    )
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"]))
    base = plain(F.col("base"))
    added = F.coalesce(F.col("added"), F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>"))
    return found.join(judged, "_row", "left").select(
        F.col("_id").alias(id_col),
        F.array_sort(base).alias("base"),
        F.array_sort(F.concat(base, added)).alias("spans"),
        F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared"),
        F.coalesce("repositories", F.lit(0)).cast("long").alias("repositories"),
        *[F.col(f"_k_{c}") for c in keep_columns],
    )


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op4: all documents; a document is a repository, its source the owner."""
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        "n_example",
        "n_live",
    )


def redacted(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The same documents; every span of their texts, overlapping ones merged, is replaced by ``mask``.

    ``n_chars``, where there is such a column, follows the text.  Null and empty texts stay as they are,
    repeated rows and rows with null ids each stay, and an empty table gives an empty one.  Columns need
    no special names: they travel as ``_k_<name>``.
    """
    names = docs.columns
    found = scan(docs, keep_columns=tuple(names))
    text = F.col("_k_text")
    chunks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % _CHUNK), F.lit(0))

    def masked(chunk: Column, number: Column) -> Column:
        base = number.cast("bigint") * _CHUNK
        near = F.filter("spans", lambda s: (s["start"] < base + _CHUNK) & (s["end"] > base))
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            begin, end = s["start"] - base, F.least(s["end"] - base, F.lit(_CHUNK).cast("bigint"))
            gap = F.substring(chunk, (acc["at"] + 1).cast("int"), (begin - acc["at"]).cast("int"))
            # A span that began in an earlier chunk has its mask there.
            return F.struct(F.greatest(acc["at"], end).alias("at"), F.when(begin >= acc["at"], F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"]).alias("out"))

        return F.aggregate(near, start, step, lambda acc: F.concat(acc["out"], F.substring(chunk, (acc["at"] + 1).cast("int"), F.lit(_CHUNK))))

    clean = F.when(F.size("spans") > 0, F.array_join(F.transform(chunks, masked), "")).otherwise(text)
    changed = {"text": clean}
    if "n_chars" in names:
        changed["n_chars"] = F.when(F.size("spans") > 0, F.char_length(clean).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_k_n_chars"))
    return found.select(*[changed.get(c, F.col(f"_k_{c}")).alias(c) for c in names])


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS own, coalesce(text, '') AS t FROM documents),
hits AS (
  SELECT doc_id, own, 0 AS rank, string_split_regex(t, p) AS gaps, regexp_extract_all(t, p) AS ms, regexp_extract_all(t, p, 2) AS vs
  FROM d, (SELECT '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS p)
  UNION ALL
  SELECT doc_id, own, rank, string_split_regex(t, p), regexp_extract_all(t, p), regexp_extract_all(t, p)
  FROM d, (VALUES (1, 'AKIA[A-Z0-9]{12,}'), (2, '[0-9a-f]{32,}'), (3, '[A-Za-z0-9+/_=-]{20,}')) AS k(rank, p)),
one AS (
  SELECT doc_id, own, rank, vs[i] AS v,
    coalesce(list_sum(list_transform(gaps[1:i], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(ms[1:i-1], lambda m: length(m))), 0) AS s, length(ms[i]) AS n
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM hits)),
span AS (
  SELECT doc_id, own, rank, md5(v) AS v, s::BIGINT AS s, (s + n)::BIGINT AS e FROM one
  WHERE rank IN (1, 2) OR (rank = 0 AND length(v) >= 8) OR (rank = 3 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]'))),
used AS (
  SELECT * FROM span c WHERE rank < 3 OR NOT EXISTS (SELECT 1 FROM span b WHERE b.rank < 3 AND b.doc_id = c.doc_id AND b.s < c.e AND c.s < b.e)),
freq AS (SELECT v, count(DISTINCT doc_id) AS repos, count(DISTINCT own) AS owners FROM used GROUP BY v),
judged AS (SELECT u.*, owners >= 3 AS ex, owners = 1 AS live, ['assign', 'access', 'hex', 'owned'][rank + 1] || ':' || s || ':' || e AS txt FROM used u JOIN freq USING (v)),
per AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS k, count(*) FILTER (rank = 2) AS h,
    string_agg(txt, ',' ORDER BY s, rank, e) FILTER (rank < 3) AS base, string_agg(txt, ',' ORDER BY s, rank, e) FILTER (rank < 3 OR live) AS spans,
    count(*) FILTER (ex) AS n_example, count(*) FILTER (live) AS n_live
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_example, 0)::BIGINT AS n_example, coalesce(n_live, 0)::BIGINT AS n_live
FROM d LEFT JOIN per USING (doc_id)
"""
