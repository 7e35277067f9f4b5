"""Ordered access to the lines of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def source_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no from 1, text)."""
    return df.select(key, F.posexplode(F.split(text, "\n", -1)).alias("_p", "text")).select(key, (F.col("_p") + 1).alias("line_no"), "text")


def slice_lines(text: Column, start: Column | int, end: Column | int) -> Column:
    """Lines start..end of a text, clipped (S13-S15, J10, L5): no join and no explode."""
    start, end = (F.lit(x) if isinstance(x, int) else x for x in (start, end))
    first = F.greatest(start, F.lit(1))
    return F.array_join(F.slice(F.split(text, "\n", -1), first, F.greatest(end - first + 1, F.lit(0))), "\n")


def slices(ranges: DataFrame, files: DataFrame, file: str, text: str, start: str, end: str, out: str = "body") -> DataFrame:
    """Each range's lines from its file; one join on the file."""
    return ranges.join(files.select(file, F.split(text, "\n", -1).alias("_l")), file).withColumn(out, F.array_join(F.slice("_l", F.greatest(F.col(start), F.lit(1)), F.greatest(F.col(end) - F.greatest(F.col(start), F.lit(1)) + 1, F.lit(0))), "\n")).drop("_l")


def previous_effective(lines: DataFrame, key: str, effective: Column) -> DataFrame:
    """The nearest earlier line that counts."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("previous", F.last(F.when(effective, F.trim("text")), ignorenulls=True).over(w))


def context(lines: DataFrame, key: str, hit: Column, before: int, after: int) -> DataFrame:
    """Lines around each hit, clipped to the text."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(-before, after)
    return lines.withColumn("snippet", F.array_join(F.collect_list("text").over(w), "\n")).where(hit)


def first_context(df: DataFrame, key: str, text: str, prefix: str, before: int, after: int, head: int) -> DataFrame:
    """Lines around the first line with the prefix, else the head of the text."""
    lines = F.split(text, "\n", -1)
    at = F.array_position(F.transform(lines, lambda x: F.startswith(x, F.lit(prefix))), True)
    first = F.greatest(at - before, F.lit(1)).cast("int")
    found = F.array_join(F.slice(lines, first, (at + after - first + 1).cast("int")), "\n")
    return df.select(key, F.when(at > 0, at).cast("long").alias("line_no"), F.when(at > 0, found).otherwise(F.array_join(F.slice(lines, 1, head), "\n")).alias("snippet"))


def continued(lines: DataFrame, key: str, ends_open: Column) -> DataFrame:
    """Lines joined with the following ones while they end open (W5): (key, start, line_count, text)."""
    w = Window.partitionBy(key).orderBy("line_no")
    fresh = F.when(F.lag(ends_open).over(w), 0).otherwise(1)
    rows = lines.withColumn("_new", fresh).withColumn("_g", F.sum("_new").over(w))
    listed = F.array_sort(F.collect_list(F.struct("line_no", "text")))
    return rows.groupBy(key, "_g").agg(F.min("line_no").alias("start"), F.count("*").alias("line_count"), F.array_join(F.transform(listed, lambda x: x["text"]), "\n").alias("text")).drop("_g")


def concatenated(df: DataFrame, keys: list[str], order: list[str], piece: Column, separator: str, out: str) -> DataFrame:
    """Pieces of a group in order."""
    listed = F.array_sort(F.collect_list(F.struct(*order, piece.alias("_piece"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["_piece"]), separator).alias(out))


def comment_lines(text: Column) -> Column:
    """For each line of a text: does it hold a comment and nothing else?"""
    bare = F.split(strip_block_comments(text), "\n", -1)
    only = lambda line, left: (F.trim(line) != "") & ((F.trim(left) == "") | F.startswith(F.trim(left), F.lit("//")))
    return F.zip_with(F.split(text, "\n", -1), bare, only)


def doc_comment_start(comments: Column, start: Column, lines: Column | None = None) -> Column:
    """First line of the comments directly above line ``start`` (H3, W4), or ``start`` itself; see ``comment_lines``.

    With ``lines`` a known flaw is kept: from a block comment of one line among these the search goes on up
    to the next line that opens a block comment, or to the start of the text.
    """
    numbered = lambda flags: F.filter(F.transform(flags, lambda c, i: F.when(c, i + 1)), lambda i: i.isNotNull())
    last = lambda flags, before: F.coalesce(F.array_max(F.filter(numbered(flags), lambda i: i < before)), F.lit(0))
    first = F.least(last(F.transform(comments, lambda c: ~c), start) + 1, start)
    if lines is None:
        return first
    opens = F.transform(lines, lambda x: F.startswith(F.trim(x), F.lit("/*")))
    closed = F.transform(lines, lambda x: F.startswith(F.trim(x), F.lit("/*")) & F.endswith(F.trim(x), F.lit("*/")))
    one = last(closed, start)
    return F.when((one >= first) & (one < start), F.greatest(last(opens, one), F.lit(1))).otherwise(first)


def documented_slices(ranges: DataFrame, files: DataFrame, file: str, text: str, start: str, end: str, out: str = "body") -> DataFrame:
    """Each range's lines with the doc comment above, clipped to the text and trimmed.

    A range of a missing file gets a comment that says so (S14).
    """
    held = files.select(file, F.split(text, "\n", -1).alias("_l"), comment_lines(F.col(text)).alias("_c"))
    first = F.greatest(doc_comment_start(F.col("_c"), F.col(start)), F.lit(1))
    body = F.array_join(F.slice("_l", first, F.greatest(F.col(end) - first + 1, F.lit(0))), "\n")
    missing = F.concat(F.lit("// no source for "), F.coalesce(file, F.lit("an unknown file")), F.lit(":"), F.coalesce(F.col(start).cast("string"), F.lit("?")))
    rows = ranges.join(held, file, "left")
    return rows.withColumn(out, F.coalesce(F.regexp_replace(body, r"^\s+|\s+$", ""), missing)).drop("_l", "_c")


def strip_block_comments(text: Column) -> Column:
    """Block comments blanked, line breaks kept (H2): line numbers don't move."""
    parts = F.split(text, r"(?s)(?=/\*)|(?<=\*/)", -1)
    blank = lambda p: F.when(F.startswith(p, F.lit("/*")), F.regexp_replace(p, r"[^\n]+", "")).otherwise(p)
    return F.array_join(F.transform(parts, blank), "")


def variable_line(text: Column, name: str) -> Column:
    """Line of a variable's definition (P13): the first with the name after a blank, star or tab, else the last that has it."""
    lines = F.split(text, "\n", -1)
    at = lambda test: F.filter(F.transform(lines, lambda x, i: F.when(test(x), i + 1)), lambda i: i.isNotNull())
    good = at(lambda x: F.contains(x, F.lit(f" {name}")) | F.contains(x, F.lit(f"*{name}")) | F.contains(x, F.lit(f"\t{name}")))
    return F.coalesce(F.array_min(good), F.array_max(at(lambda x: F.contains(x, F.lit(name)))))
