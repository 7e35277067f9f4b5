"""Scalar functions on columns; regular expressions without look-around, so that SQL engines agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_WIDTH = "​‌‍⁠﻿"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bare_type(x: Column | str) -> Column:
    """A C type without const, pointers and references (H1)."""
    x = F.regexp_replace(_c(x), r"\bconst\b", " ")
    x = F.regexp_replace(x, r"[\s*&]+$", "")
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def stripped(x: Column | str) -> Column:
    """No white space of any kind at either end."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def section(x: Column | str, heading: str, stop: str) -> Column:
    """Text behind a heading up to the next stop (H4): the whole text without the heading."""
    x = _c(x)
    behind = F.substring(x, F.instr(x, heading) + len(heading), F.char_length(x))
    return F.when(F.instr(x, heading) > 0, stripped(F.split_part(behind, F.lit(stop), F.lit(1)))).otherwise(x)


def section_or_null(x: Column | str, heading: str, stop: str) -> Column:
    """The same, but null without the heading (H5)."""
    x = _c(x)
    return F.when(F.instr(x, heading) > 0, F.nullif(section(x, heading, stop), F.lit("")))


def macro_name(x: Column | str) -> Column:
    return F.regexp_extract(_c(x), r"^\s*#\s*define\s+([A-Za-z_][A-Za-z0-9_]*)", 1)


def macro_params(x: Column | str) -> Column:
    """Parameter list with its brackets, null for an object-like macro (H6)."""
    return F.nullif(F.regexp_extract(_c(x), r"^\s*#\s*define\s+[A-Za-z_][A-Za-z0-9_]*(\([^)]*\))", 1), F.lit(""))


def macro_body(x: Column | str) -> Column:
    """Body with continuations joined by line breaks (H6)."""
    body = F.regexp_replace(_c(x), r"^\s*#\s*define\s+[A-Za-z_][A-Za-z0-9_]*(\([^)]*\))?[ \t]*", "")
    return F.trim(F.regexp_replace(body, r"[ \t]*\\\n[ \t]*", "\n"))


def macro_text(name: Column | str, params: Column | str, body: Column | str) -> Column:
    """``#define`` text again, continuation lines indented (H7)."""
    return F.concat(F.lit("#define "), _c(name), F.coalesce(_c(params), F.lit("")), F.lit(" "), F.array_join(F.split(_c(body), "\n", -1), " \\\n    "))


def file_safe(x: Column | str) -> Column:
    """Blanks, commas and round brackets as underscores (H8)."""
    return F.translate(_c(x), "(), ", "____")


def base_name(x: Column | str) -> Column:
    return F.substring_index(_c(x), "/", -1)


def dir_name(x: Column | str) -> Column:
    x = _c(x)
    return F.when(F.instr(x, "/") > 0, F.regexp_replace(x, r"/[^/]*$", "")).otherwise(F.lit(""))


def normal_path(x: Column | str) -> Column:
    """A relative path without ``.`` and ``..`` where these can be resolved (H9)."""
    parts = F.filter(F.split(_c(x), "/", -1), lambda p: (p != ".") & (p != ""))

    def step(acc: Column, p: Column) -> Column:
        back = (p == "..") & (F.size(acc) > 0) & (F.coalesce(F.element_at(acc, -1), F.lit("..")) != "..")
        return F.when(back, F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(p)))

    joined = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    return F.when(F.startswith(_c(x), F.lit("/")), F.concat(F.lit("/"), joined)).otherwise(joined)


def stem(x: Column | str) -> Column:
    return F.regexp_replace(base_name(x), r"(.)\.[^.]*$", "$1")


def key(file: Column | str, name: Column | str) -> Column:
    """``file:name``."""
    return F.concat(_c(file), F.lit(":"), _c(name))


def template(pattern: str, /, **values: Column) -> Column:
    """Placeholders replaced in one pass (H11, H12): inserted text is never searched again."""
    import re

    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", pattern)):
        if i % 2 == 0:
            parts.append(F.lit(piece))
        elif piece in values:
            parts.append(F.coalesce(values[piece].cast("string"), F.lit("")))
        else:
            parts.append(F.lit("{" + piece + "}"))
    return F.concat(*parts)


def or_default(x: Column | str, default: str) -> Column:
    """A default for null and empty."""
    return F.coalesce(F.nullif(_c(x), F.lit("")), F.lit(default))


def bullets(items: Column | str, empty: str = "none") -> Column:
    """``- item`` lines."""
    items = _c(items)
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")).otherwise(F.lit(empty))


def trim_invisible(x: Column | str) -> Column:
    """Zero-width characters off both ends."""
    return F.regexp_replace(_c(x), f"^[{ZERO_WIDTH}]+|[{ZERO_WIDTH}]+$", "")


def all_matches(x: Column | str, pattern: str, group: int = 1) -> Column:
    """Every match of a pattern."""
    return F.regexp_extract_all(_c(x), F.lit(pattern), F.lit(group))


MACRO_NAMES = r"(?m)^[ \t]*#[ \t]*define[ \t]+([A-Za-z_][A-Za-z0-9_]*)"
UPPER_NAMES = r"\b([A-Z_][A-Z0-9_]*)\b"
INCLUDE_NAMES = r"(?m)^[ \t]*#[ \t]*include[ \t]+[\"<]([^\">]+)[\">]"


def question_answer(question: Column | str, answer: Column | str) -> Column:
    """One training sample in the block format."""
    return F.concat(F.lit("### Q: "), _c(question), F.lit("\n### A: "), _c(answer), F.lit("\n---"))


def split_samples(x: Column | str) -> Column:
    """Samples of a block text as array of (question, answer)."""
    blocks = F.filter(F.split(_c(x), r"\n---[ \t]*\n?", -1), lambda b: F.contains(b, F.lit("### Q:")) & F.contains(b, F.lit("### A:")))
    return F.transform(blocks, lambda b: F.struct(F.trim(F.regexp_extract(b, r"(?s)### Q:(.*?)\n### A:", 1)).alias("question"), F.trim(F.regexp_extract(b, r"(?s)\n### A:(.*)$", 1)).alias("answer")))
