"""Facts of C sources: a tokenizer, a small preprocessor and a declaration scanner.

Every file is parsed on its own and in parallel; names are resolved across files by joins later.  The
headers that a file includes, directly or not, come along as their directives, so their macros hold
where conditions ask for them.  A header's own facts are those it has by itself.
Limits: declarations that macros generate, and parameter lists in the old style, are not seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "file string, kind string, name string, owner string, value string, extra string, start_line int, end_line int, ord int"
KEYWORDS = frozenset("auto break case char const continue default do double else enum extern float for goto if inline int long register return short signed sizeof static struct switch typedef union unsigned void volatile while _Bool restrict defined __attribute__ __asm __asm__ asm".split())
_QUALIFIERS = frozenset("static extern register auto inline __inline __inline__ typedef".split())
_TOKEN = re.compile(r'[A-Za-z_]\w*|\d[\w.]*|"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'|\.\.\.|->|[^\s]')
_COMMENT = re.compile(r'//(?:\\\n|[^\n])*|/\*.*?(?:\*/|\Z)|"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'', re.S)
_DIRECTIVE = re.compile(r"^[ \t]*#[ \t]*(\w+)[ \t]*(.*)$", re.S)
_DEFINE = re.compile(r"([A-Za-z_]\w*)(\([^)]*\))?[ \t]*(.*)$", re.S)


def strip_comments(text: str) -> str:
    """Comments blanked, strings and line breaks kept."""
    return _COMMENT.sub(lambda m: m[0] if m[0][0] in "\"'" else re.sub(r"[^\n]", " ", m[0]), text)


class Headers(NamedTuple):
    """What a file can include: (including file, name) to the header's path, and headers' directives by path."""

    found: Mapping[tuple[str, str], str]
    texts: Mapping[str, str]


def directives(text: str) -> str:
    """The directive lines of a text with their continuations, comments blanked: all that an includer needs."""
    out, inside = [], False
    for line in strip_comments(text or "").split("\n"):
        if inside or line.lstrip().startswith("#"):
            out.append(line)
            inside = line.rstrip().endswith("\\")
        elif out and out[-1]:
            out.append("")  # what stands between two directives matters for guards only
    return "\n".join(out)


def preprocess(text: str, defines: Mapping[str, str] = {}, file: str = "", headers: Headers | None = None) -> tuple[list[str], list[tuple]]:
    """Active lines without directives, and (kind, name, value, extra, line, end) of macros and includes."""
    return _walk(text, dict(defines), file, headers or Headers({}, {}), [], set())


def _walk(text: str, known: dict[str, str], file: str, headers: Headers, above: list[str], once: set[str]) -> tuple[list[str], list[tuple]]:
    lines = strip_comments(text).split("\n")
    out, found = [""] * len(lines), []
    stack: list[list[bool]] = []  # [active, some branch was taken, enclosing active]
    effective, i = "", 0
    while i < len(lines):
        start, line = i, lines[i]
        while line.rstrip().endswith("\\") and i + 1 < len(lines):
            i += 1
            line = line.rstrip()[:-1] + "\n" + lines[i]
        active = not stack or stack[-1][0]
        m = _DIRECTIVE.match(line)
        if not m:
            if active:
                for k in range(start, i + 1):
                    out[k] = lines[k].rstrip().removesuffix("\\") if i > start else lines[k]
        else:
            word, rest = m[1], m[2].strip()
            if word in ("if", "ifdef", "ifndef"):
                on = active and _holds(word, rest, known)
                stack.append([on, on, active])
            elif word in ("elif", "else") and stack:
                on = stack[-1][2] and not stack[-1][1] and (word == "else" or _holds("if", rest, known))
                stack[-1][0] = on
                stack[-1][1] = stack[-1][1] or on
            elif word == "endif" and stack:
                stack.pop()
            elif active and word == "define" and (d := _DEFINE.match(rest)):
                body = re.sub(r"[ \t]*\n[ \t]*", "\n", d[3]).strip()
                guard = not body and not d[2] and effective.startswith("#ifndef ") and d[1] in effective[8:]
                known[d[1]] = body
                if not guard:
                    found.append(("macro", d[1], body, d[2], start + 1, i + 1))
            elif active and word == "undef":
                known.pop(rest, None)
            elif active and word == "pragma" and rest.split()[:1] == ["once"]:
                once.add(file)
            elif active and word == "include" and (d := re.match(r'(["<])([^">]+)[">]', rest)):
                found.append(("include", d[2], None, "quoted" if d[1] == '"' else "angled", start + 1, i + 1))
                path = headers.found.get((file, d[2]))
                if path in headers.texts and path not in above and path not in once and path != file:
                    _walk(headers.texts[path], known, path, headers, [*above, file], once)
        if line.strip():
            effective = re.sub(r"^#[ \t]+", "#", line.strip())
        i += 1
    return out, found


def _holds(word: str, rest: str, known: Mapping[str, str]) -> bool:
    if word == "ifdef":
        return rest.split()[0] in known if rest else False
    if word == "ifndef":
        return rest.split()[0] not in known if rest else False
    text = re.sub(r"defined\s*(?:\(\s*(\w+)\s*\)|(\w+))", lambda m: "1" if (m[1] or m[2]) in known else "0", rest)
    try:
        return bool(_Condition(_expanded(text, known, frozenset())).value())
    except (ValueError, RecursionError):
        return False


def _expanded(text: str, known: Mapping[str, str], inside: frozenset[str]) -> list[str]:
    """Tokens of a condition with macros expanded; a macro inside its own expansion is left, and counts as 0."""
    out = []
    for m in _CONDITION.finditer(text):
        t = m[0]
        if (t[0].isalpha() or t[0] == "_") and t in known and t not in inside:
            out += _expanded(known[t] or "1", known, inside | {t})
            if len(out) > 100_000:
                raise ValueError("a condition grows without end")
        else:
            out.append(t)
    return out


_CONDITION = re.compile(r"[A-Za-z_]\w*|0[xX][0-9a-fA-F]+[uUlL]*|\d\w*|'(?:\\.|[^'\\])'|<<|>>|<=|>=|==|!=|&&|\|\||\S")
_LEVELS = (("||",), ("&&",), ("|",), ("^",), ("&",), ("==", "!="), ("<", "<=", ">", ">="), ("<<", ">>"), ("+", "-"), ("*", "/", "%"))


class _Condition:
    """Integer conditions with C's operators, in 64 bits; anything else is a ValueError."""

    def __init__(self, tokens: list[str]):
        self.tokens, self.at = [*tokens, ""], 0

    def take(self, *some: str) -> str:
        t = self.tokens[self.at]
        if t and t in some:
            self.at += 1
            return t
        return ""

    def value(self) -> int:
        v = self.choice()
        if self.tokens[self.at]:
            raise ValueError(self.tokens[self.at])
        return v

    def choice(self) -> int:
        v = self.binary(0)
        if not self.take("?"):
            return v
        a = self.choice()
        if not self.take(":"):
            raise ValueError("?")
        b = self.choice()
        return a if v else b

    def binary(self, level: int) -> int:
        if level == len(_LEVELS):
            return self.unary()
        a = self.binary(level + 1)
        while op := self.take(*_LEVELS[level]):
            a = _wrapped(_applied(op, a, self.binary(level + 1)))
        return a

    def unary(self) -> int:
        op = self.take("!", "-", "+", "~", "(")
        if op == "(":
            v = self.choice()
            if not self.take(")"):
                raise ValueError("(")
            return v
        if op:
            v = self.unary()
            return int(not v) if op == "!" else _wrapped(-v if op == "-" else ~v if op == "~" else v)
        t = self.tokens[self.at]
        self.at += 1
        if t[:1] == "'":
            return ord(t[1]) if len(t) == 3 else {"n": 10, "t": 9, "r": 13, "0": 0}.get(t[2], ord(t[2]))
        if t[:1].isdigit():
            digits = t.rstrip("uUlL")
            return _wrapped(int(digits, 8 if digits[0] == "0" and digits.isdigit() else 0))
        if t[:1].isalpha() or t[:1] == "_":
            if self.take("("):  # an unknown function-like macro
                depth = 1
                while depth and self.tokens[self.at]:
                    depth += (self.tokens[self.at] == "(") - (self.tokens[self.at] == ")")
                    self.at += 1
            return 0
        raise ValueError(t)


def _wrapped(v: int) -> int:
    return ((v + (1 << 63)) & ((1 << 64) - 1)) - (1 << 63)


def _applied(op: str, a: int, b: int) -> int:
    if op in ("/", "%"):
        if not b:
            raise ValueError("division by zero")
        q = abs(a) // abs(b) * (1 if (a < 0) == (b < 0) else -1)
        return q if op == "/" else a - q * b
    if op in ("<<", ">>"):
        return a << (b & 63) if op == "<<" else a >> (b & 63)
    simple = {"||": lambda: int(bool(a or b)), "&&": lambda: int(bool(a and b)), "|": lambda: a | b, "^": lambda: a ^ b, "&": lambda: a & b, "==": lambda: int(a == b), "!=": lambda: int(a != b), "<": lambda: int(a < b), "<=": lambda: int(a <= b), ">": lambda: int(a > b), ">=": lambda: int(a >= b), "+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b}
    return simple[op]()


class _Parser:
    def __init__(self, lines: list[str]):
        self.tokens = [(m[0], n) for n, line in enumerate(lines, 1) for m in _TOKEN.finditer(line)]
        self.rows: list[tuple] = []

    def close(self, i: int) -> int:
        """Index of the bracket that closes the one at i; the last token if none does."""
        pairs = {"(": ")", "{": "}", "[": "]"}
        depth, a = 0, self.tokens[i][0]
        b = pairs[a]
        for k in range(i, len(self.tokens)):
            t = self.tokens[k][0]
            depth += (t == a) - (t == b)
            if not depth:
                return k
        return len(self.tokens) - 1

    def add(self, kind, name, owner=None, value=None, extra=None, start=None, end=None):
        self.rows.append((kind, name, owner, value, extra, start, end))

    def run(self) -> list[tuple]:
        i, n = 0, len(self.tokens)
        while i < n:
            made, begin = len(self.rows), i
            i = self.declaration(i)
            if not any(r[0] == "function" for r in self.rows[made:]):
                self.outside(begin, i, {r[1] for r in self.rows[made:]})
        return self.rows

    def outside(self, begin: int, end: int, declared: set[str]) -> None:
        """Uses at file scope, of the owner ``global``: types of variables and fields, initialisers, sizes."""
        uses, types = {}, {}
        for p in range(begin, min(end, len(self.tokens))):
            t, line = self.tokens[p]
            if not re.match(r"[A-Za-z_]\w*$", t) or t in KEYWORDS or t in declared:
                continue
            before = self.tokens[p - 1][0] if p > begin else ""
            if before in ("struct", "union", "enum"):
                types.setdefault(t, before)
            elif before not in (".", "->"):
                uses.setdefault(t, line)
        for t, line in uses.items():
            self.add("use", t, "global", start=line)
        for t, kind in types.items():
            self.add("type_use", t, "global", kind)

    def declaration(self, i: int) -> int:
        begin, k, n = i, i, len(self.tokens)
        base: list[str] | None = None
        while k < n:
            t = self.tokens[k][0]
            if t == ";":
                self.variables(begin, k, base)
                return k + 1
            if t == "}":
                return k + 1
            if t == "(":
                k = self.close(k) + 1
                continue
            if t == "{":
                words = [x for x, _ in self.tokens[begin:k]]
                heads = [p for p, x in enumerate(words) if x in ("struct", "union", "enum")]
                if "=" in words:
                    k = self.close(k) + 1
                elif heads and ")" not in words[heads[-1] :]:
                    end = self.close(k)
                    at = heads[-1]
                    tag = words[at + 1] if at + 1 < len(words) and re.match(r"[A-Za-z_]\w*$", words[at + 1]) else None
                    name = tag
                    if name is None:
                        after = [x for x, _ in self.tokens[end + 1 : end + 3]]
                        name = after[0] if "typedef" in words and after and re.match(r"[A-Za-z_]\w*$", after[0]) else None
                    if name:
                        self.type_body(words[at], name, k, end, self.tokens[begin][1])
                    base = [words[at], name or "(anonymous)"]
                    if "typedef" in words or "extern" in words or "static" in words:
                        base = [w for w in words[:at] if w in ("typedef", "extern", "static")] + base
                    begin = k = end + 1
                elif "extern" in words and len(words) == 2 and words[1].startswith('"'):
                    return k + 1  # extern "C" {
                else:
                    return self.function(begin, k)
                continue
            k += 1
        return n

    def function(self, begin: int, brace: int) -> int:
        end = self.close(brace)
        k, name = begin, None
        parameters = (0, 0)
        while k < brace:
            t = self.tokens[k][0]
            if t == "(":
                before = self.tokens[k - 1][0] if k > begin else ""
                if re.match(r"[A-Za-z_]\w*$", before) and before not in KEYWORDS and name is None:
                    name, parameters = before, (k, self.close(k))
                k = self.close(k)
            k += 1
        if name is None:
            return end + 1
        self.add("function", name, start=self.tokens[begin][1], end=self.tokens[end][1])
        local = self.locals(parameters[0] + 1, parameters[1]) | self.locals(brace + 1, end)
        calls, uses, types = {}, {}, {}
        for p in range(begin, end):
            t = self.tokens[p][0]
            if not re.match(r"[A-Za-z_]\w*$", t) or t in KEYWORDS:
                continue
            before, after = self.tokens[p - 1][0] if p else "", self.tokens[p + 1][0]
            if before in ("struct", "union", "enum"):
                types[t] = before
            elif before in (".", "->"):
                continue
            elif p > brace and after == "(" and t not in local:
                calls.setdefault(t, self.tokens[p][1])
            elif t not in local and t != name:
                uses.setdefault(t, self.tokens[p][1])
        for t, line in calls.items():
            self.add("call", t, name, start=line)
        for t, line in (calls | uses).items():
            self.add("use", t, name, start=line)
        for t, kind in types.items():
            self.add("type_use", t, name, kind)
        return end + 1

    def locals(self, a: int, b: int) -> set[str]:
        """Names that a declaration between a and b introduces: a name that follows a type name or a star."""
        found = set()
        for p in range(a, b):
            t, after = self.tokens[p][0], self.tokens[p + 1][0] if p + 1 < len(self.tokens) else ""
            if not re.match(r"[A-Za-z_]\w*$", t) or t in KEYWORDS or after not in ("=", ";", ",", "[", ")", ":"):
                continue
            q = p - 1
            while q >= a and self.tokens[q][0] == "*":
                q -= 1
            x = self.tokens[q][0] if q >= a else ""
            typed = x in ("int", "char", "long", "short", "float", "double", "void", "unsigned", "signed", "const", "_Bool") or re.match(r"[A-Za-z_]\w*$", x) and x not in KEYWORDS
            if typed and x not in ("return", "goto", "case"):
                found.add(t)
        return found

    def variables(self, begin: int, end: int, base: list[str] | None) -> None:
        words, k = list(base or []), begin
        while k < end:
            if self.tokens[k][0] == "{":
                k = self.close(k)
            else:
                words.append(self.tokens[k][0])
            k += 1
        if not words:
            return
        parts: list[list[str]] = [[]]
        depth = 0
        for w in words:
            depth += (w in "([") - (w in ")]")
            if w == "," and not depth:
                parts.append([])
            else:
                parts[-1].append(w)
        head = parts[0]
        if "=" in head:
            head = head[: head.index("=")]
        pointer = self.pointer_name(head)
        plain = [w for w in head if w not in _QUALIFIERS]
        if "(" in head and not pointer:
            return  # a prototype, or a macro call
        names = []
        for i, part in enumerate(parts):
            part = part[: part.index("=")] if "=" in part else part
            name = self.pointer_name(part)
            if not name:
                cut = part[: part.index("[")] if "[" in part else part
                cut = cut[: cut.index(":")] if ":" in cut else cut
                ids = [w for w in cut if re.match(r"[A-Za-z_]\w*$", w) and w not in KEYWORDS]
                name = ids[-1] if ids else None
            names.append(name)
        first = names[0]
        if not first or pointer is None and len(plain) < 2:
            return
        cut = plain[: len(plain) - 1 - plain[::-1].index(first)] if not pointer else plain
        type_text = " ".join(cut).replace("* *", "**")
        if not type_text or type_text in ("struct " + first, "union " + first, "enum " + first, "struct", "union", "enum"):
            return
        line, last = self.tokens[min(begin, len(self.tokens) - 1)][1], self.tokens[end][1]
        for name in names:
            if not name:
                continue
            if "typedef" in words:
                self.add("typedef", name, value=type_text, start=line, end=last)
            else:
                self.add("global", name, value=type_text, extra="declaration" if "extern" in words else "definition", start=line, end=last)

    @staticmethod
    def pointer_name(part: list[str]) -> str | None:
        for i in range(len(part) - 3):
            if part[i] == "(" and part[i + 1] == "*" and re.match(r"[A-Za-z_]\w*$", part[i + 2]):
                return part[i + 2]
        return None

    def type_body(self, kind: str, name: str, brace: int, end: int, line: int) -> None:
        self.add("type", name, value=kind, start=line, end=self.tokens[end][1])
        if kind == "enum":
            self.enum_values(name, brace, end)
        else:
            self.fields(name, "", brace, end)

    def enum_values(self, owner: str, brace: int, end: int) -> None:
        k, next_value = brace + 1, 0
        while k < end:
            name = self.tokens[k][0]
            k += 1
            value: list[str] = []
            while k < end and self.tokens[k][0] != ",":
                value.append(self.tokens[k][0])
                k += 1
            k += 1
            if value[:1] == ["="]:
                text = "".join(value[1:])
                m = re.fullmatch(r"\(?(-?(?:0[xX][0-9a-fA-F]+|\d+))[uUlL]*\)?", text)
                next_value = int(m[1], 0 if not re.fullmatch(r"-?0\d+", m[1]) else 8) if m else None
            if re.match(r"[A-Za-z_]\w*$", name):
                self.add("enum_value", name, owner, None if next_value is None else str(next_value))
            next_value = None if next_value is None else next_value + 1

    def fields(self, owner: str, path: str, brace: int, end: int) -> None:
        k = begin = brace + 1
        nested = None
        ordinal = 0
        while k < end:
            t = self.tokens[k][0]
            if t == "{":
                close = self.close(k)
                words = [x for x, _ in self.tokens[begin:k]]
                kind = next((w for w in words if w in ("struct", "union", "enum")), "struct")
                nested = (kind, k, close)
                k = close + 1
            elif t == ";":
                words = [x for x, _ in self.tokens[(nested[2] + 1) if nested else begin : k]]
                for name, text in self.declarators(words, nested[0] if nested else None):
                    self.add("field", name, owner, text, f"{path}|{nested[0] if nested else ''}", self.tokens[begin][1], ordinal)
                    if nested:
                        inner = f"{path}/{ordinal}" if not name else f"{path}/{name}"
                        (self.enum_values if nested[0] == "enum" else lambda o, a, b: self.fields(o, inner, a, b))(owner, nested[1], nested[2])
                    ordinal += 1
                nested, begin = None, k + 1
                k += 1
            else:
                k = self.close(k) + 1 if t in "([" else k + 1

    def declarators(self, words: list[str], nested: str | None) -> list[tuple[str, str]]:
        if nested and not [w for w in words if re.match(r"[A-Za-z_]", w)]:
            return [("", nested)]
        if (name := self.pointer_name(words)) is not None:
            return [(name, " ".join(w for w in words if w != name))]
        parts: list[list[str]] = [[]]
        for w in words:
            if w == ",":
                parts.append([])
            else:
                parts[-1].append(w)
        out, base = [], None
        for part in parts:
            bits = part.index(":") if ":" in part else len(part)
            array = part.index("[") if "[" in part else bits
            ids = [i for i, w in enumerate(part[: min(bits, array)]) if re.match(r"[A-Za-z_]\w*$", w)]
            if not ids:
                continue
            at = ids[-1]
            if base is None:
                base = [w for w in part[:at] if w != "*"] or ([nested] if nested else [])
            stars = [w for w in part[:at] if w == "*"]
            out.append((part[at], " ".join(base + stars) + "".join(part[array:bits]) + ("" if bits == len(part) else " : " + "".join(part[bits + 1 :]))))
        return out


def parse(text: str, defines: Mapping[str, str] = {}, file: str = "", headers: Headers | None = None) -> list[tuple]:
    """(kind, name, owner, value, extra, start_line, end_line) of every fact in order."""
    lines, found = preprocess(text or "", defines, file, headers)
    rows = [(kind, name, None, value, extra, start, end) for kind, name, value, extra, start, end in found]
    return rows + _Parser(lines).run()


def facts(files: DataFrame, path: str = "path", text: str = "text", defines: Mapping[str, str] = {}, includes: DataFrame | None = None) -> DataFrame:
    """Facts of every file (S2, S3, I12, H25); null text has none.

    includes: (file, wanted, found), each include's header.  Without it headers are not looked into.
    """
    defines = dict(defines)
    rows = files.select(F.col(path).alias("_p"), F.col(text).alias("_t"))
    if includes is not None:
        rows = rows.join(_headers(rows, includes), "_p", "left")
    # Parsing costs far more than moving sources, and a scan's partitions may be few.
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["file", "kind", "name", "owner", "value", "extra", "start_line", "end_line", "ord"]
        for batch in batches:
            made = []
            links = batch["_links"] if "_links" in batch else [None] * len(batch)
            for file, body, some in zip(batch["_p"], batch["_t"], links):
                headers = Headers({}, {})
                for link in some if some is not None else ():
                    headers.found[link["file"], link["wanted"]] = link["found"]
                    headers.texts[link["found"]] = link["lines"]
                made += [(file, *row, i) for i, row in enumerate(parse(body, defines, file, headers))]
            out = pd.DataFrame(made, columns=columns)
            yield out.astype({"start_line": "Int32", "end_line": "Int32", "ord": "int32"})

    return rows.mapInPandas(run, SCHEMA)


def _headers(files: DataFrame, includes: DataFrame) -> DataFrame:
    """(_p, _links) of files that include others: all links they follow, directly or not, with the headers' directives.

    A unit sees its headers however often others see them too, so this grows with the units' closures;
    headers travel as their directives only.
    """
    from ..operators import graph

    links = graph._cut(includes.where("found IS NOT NULL").select("file", "wanted", "found").distinct())
    reach = graph.closure(links.select(F.col("file").alias("src"), F.col("found").alias("dst")))

    @F.pandas_udf("string")
    def skeleton(texts: pd.Series) -> pd.Series:
        return texts.map(directives)

    seen = links.select(F.col("found").alias("_p")).distinct()
    lines = graph._cut(files.join(seen, "_p", "left_semi").select(F.col("_p").alias("found"), skeleton("_t").alias("lines")))
    # The links of a unit are its own and those of every header it reaches.
    owners = reach.select(F.col("src").alias("_p"), F.col("dst").alias("file")).union(links.select("file", "file").distinct())
    rows = owners.distinct().join(links, "file").join(lines, "found")
    return rows.groupBy("_p").agg(F.collect_list(F.struct("file", "wanted", "found", "lines")).alias("_links"))
