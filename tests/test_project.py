"""The C front end, project readers, facts, modules, prompts and the command line on an own small project."""

import json
import os

import pytest
from pyspark.sql import functions as F

from factloom import cli, sinks
from factloom.operators import graph, modules
from factloom.plans import analyze as A
from factloom.plans import prompts as P
from factloom.sources import cparse, files as S

FILES = {
    "main.c": '#include "lib/shape.h"\n#include "missing.h"\n// starts\nint total = 1, *cursor;\nextern int far_away;\nint main(void)\n{\n    setup_all();\n    run_loop(total);\n    area(2);\n    printf("area(%d)", total);\n    return 0;\n}\n',
    "lib/shape.h": "#ifndef SHAPE_H\n#define SHAPE_H\n#define SQUARE(x) ((x) * \\\n    (x))\n#define LIMIT 5\n#ifdef WITH_COLOR\nint colour;\n#endif\nstruct Point { int x; int y; union { int a; float b; }; };\ntypedef struct Point point_t;\nenum Mode { OFF, ON = 4, AUTO };\n#endif\n",
    "lib/shape_area.c": '#include "shape.h"\n/* area of a square */\nint area(int side)\n{\n    int total = SQUARE(side);\n    struct Point p;\n    return helper(total) + LIMIT;\n}\nstatic int helper(int x) { return x; }\n',
    "lib/shape_more.c": "int helper(int x) { return x + 1; }\nint more(point_t *p)\n{\n    return helper(p->x) + area(1);\n}\n",
    "sys/init_clock.c": "void setup_all(void) { clock_on(); }\n",
    "sys/clock.c": "void clock_on(void) { clock_on(); }\nvoid run_loop(int n) { while (n) n--; }\n",
    "startup.s": "__Vectors DCD __initial_sp\n DCD Reset_Handler\n DCD Tick_Handler\n__Vectors_End\nReset_Handler PROC\n EXPORT Reset_Handler [WEAK]\n EXPORT Tick_Handler [WEAK]\n EXPORT setup_all [WEAK]\n EXPORT Strong\n LDR R0, =SystemInit\n LDR R0, =__main\n ENDP\n",
    "app.uvprojx": "<P><Target><IncludePath>lib;.\\sys; ;lib</IncludePath><Define>WITH_COLOR, LEVEL=3</Define></Target></P>\n",
}


@pytest.fixture(scope="module")
def project(tmp_path_factory):
    root = tmp_path_factory.mktemp("project")
    for name, text in FILES.items():
        path = root / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
    return str(root)


@pytest.fixture(scope="module")
def read(spark, project):
    return A.read_project(spark, project)


@pytest.fixture(scope="module")
def found(read):
    return A.facts(*read)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_settings(read):
    files, startup, includes, defines = read
    assert rows(files, "path") == sorted((n,) for n in FILES if n.endswith((".c", ".h")))
    assert defines == {"WITH_COLOR": "1", "LEVEL": "3"}
    assert [r[0] for r in includes.orderBy("ord").select("dir").collect()] == ["lib", "./sys"]
    assert startup.first().path == "startup.s"


def test_calls_and_functions(found):
    edges = rows(found.edges.na.fill("?"), "caller_file", "caller", "callee_file", "callee")
    assert ("lib/shape_area.c", "area", "lib/shape_area.c", "helper") in edges
    assert ("lib/shape_more.c", "more", "lib/shape_more.c", "helper") in edges
    assert ("main.c", "main", "?", "printf") in edges and ("main.c", "main", "sys/init_clock.c", "setup_all") in edges
    assert ("startup.s", "Reset_Handler", "main.c", "main") in edges and not [e for e in edges if e[3] == "SQUARE"]
    names = {r[1] for r in rows(found.functions, "file", "name") if r[0] == "startup.s"}
    assert names == {"Reset_Handler", "Tick_Handler", "Strong"}


def test_macros_types_globals(found):
    assert rows(found.macros.na.fill(""), "name", "params") == [("LIMIT", ""), ("SQUARE", "(x)")]
    assert rows(found.macro_uses, "name", "use_function") == [("LIMIT", "area"), ("SQUARE", "area")]
    assert rows(found.types, "kind", "name") == [("enum", "Mode"), ("struct", "Point")]
    assert rows(found.enum_values, "name", "value") == [("AUTO", 5), ("OFF", 0), ("ON", 4)]
    assert ("a", "/2") in rows(found.fields, "name", "parent_path")
    assert rows(found.type_uses, "name", "use_function") == [("Point", "area"), ("Point", "global"), ("Point", "more")]
    assert rows(found.globals_, "name", "type_text") == [("colour", "int"), ("cursor", "int"), ("total", "int")]
    assert rows(found.global_uses, "name", "use_function") == [("total", "main")]  # a local of that name hides it
    assert ("main.c", "lib/shape.h") in rows(found.includes, "file", "included") and ("main.c", "missing.h") in rows(found.includes, "file", "included")


def test_file_scope_uses_and_included_macros(spark):
    files = {
        "inc/cfg.h": "#ifndef CFG\n#define CFG\n#include \"deep.h\"\n#define FEATURE (DEEP - 1)\n#endif\n",
        "inc/deep.h": "#pragma once\n#include \"cfg.h\"\n#define DEEP 2\n#define SIZE 8\nstruct Cell { int v; };\n",
        "src/a.c": "#include \"../inc/cfg.h\"\n#if FEATURE == 1 && !defined(NO)\nint on(void) { return used(); }\n#else\nint off(void) { return 0; }\n#endif\nstruct Cell cells[SIZE];\nint other = SIZE;\n",
        "src/b.c": "#include <stdio.h>\n#include \"gone.h\"\n#if 9**9**8\nint never(void) { return 0; }\n#endif\nextern int other;\nint *at = &other;\n",
    }
    df = spark.createDataFrame([(k, v, len(v)) for k, v in files.items()], "path string, text string, size long")
    f = A.facts(df)
    assert rows(f.functions, "file", "name") == [("src/a.c", "on")]
    assert rows(f.includes, "file", "included") == [("inc/cfg.h", "inc/deep.h"), ("inc/deep.h", "inc/cfg.h"), ("src/a.c", "inc/cfg.h"), ("src/b.c", "gone.h"), ("src/b.c", "stdio.h")]
    assert rows(A.missing_includes(df), "wanted") == [("gone.h",)]
    assert rows(f.macro_uses, "name", "use_file", "use_function") == [("SIZE", "src/a.c", "global")]
    assert rows(f.type_uses, "name", "use_function") == [("Cell", "global")] and A.in_functions(f.type_uses).count() == 0
    assert rows(f.global_uses, "name", "use_file", "use_function") == [("other", "src/b.c", "global")]
    assert dict(rows(A.progress(f), "kind", "n")) == {"calls": 1, "files": 4, "functions": 1, "globals": 3, "macros": 3, "types": 1}


@pytest.mark.parametrize("text,value", [("A > 2 && defined(B)", 1), ("B == 4", 1), ("L == 16", 1), ("A ? 0 : 1", 0), ("1 << 70", 1), ("5 / 0", 0), ("X", 0), ("'a' == 97", 1), ("UNK(1,2) || 1", 1), ("010 == 8", 1), ("~0 == -1", 1), ("-7 % 4 == -3", 1), ("9**9**8", 0), ("(", 0), (" + ".join(["1"] * 3000) + " == 3000", 1)])
def test_conditions(text, value):
    known = {"A": "3", "B": "(A + 1)", "L": "0x10UL", "X": "X"}
    assert cparse._holds("if", text, known) == bool(value)


def test_module_prompts_tell_of_dependencies(found, read):
    done = {r.entity_key: r for r in A.document_modules(found, read[0], P.OfflineStub(), 2).collect()}
    assert set(done) == {"main", "init_clock", "shape"}
    assert "shape: stub:" in done["main"].prompt and "stub:" not in done["shape"].prompt


def test_chat_service():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    asked = []

    class Service(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, self.headers["Authorization"], body))
            text = body["messages"][0]["content"]
            code = 400 if text == "bad" else 503 if text == "busy" and len(asked) < 3 else 200
            self.send_response(code)
            self.end_headers()
            if code == 200:
                self.wfile.write(json.dumps({"choices": [{"message": {"content": f"\u200b{text}!"}}]}).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    settings = {"base_url": f"http://127.0.0.1:{server.server_port}/v1", "api_key": "k", "model": "m", "temperature": 0.5}
    ask = P.completer(settings)
    ask.pause = 0.01
    assert ask(["busy", "bad", None]) == ["\u200bbusy!", None, None]
    assert asked[0][:2] == ("/v1/chat/completions", "Bearer k") and asked[0][2]["temperature"] == 0.5 and len(asked) == 4
    assert P.completer(settings | {"api_key": "your-key"})(["x"]) == [None] and isinstance(P.completer({}), P.OfflineStub)
    server.shutdown()


def test_modules(found):
    members, deps = A.module_tables(found)
    got = dict((f, m) for m, f in rows(members, "module", "file"))
    assert got["main.c"] == "main" and got["sys/init_clock.c"] == got["sys/clock.c"] == "init_clock"
    assert got["lib/shape_area.c"] == got["lib/shape_more.c"] == "shape" and "lib/shape.h" not in got
    assert rows(deps, "module", "dependency") == [("main", "init_clock"), ("main", "shape")]


def test_prompts_by_level(found, read):
    done = {r.entity_key: r for r in A.document_functions(found, read[0], P.OfflineStub(), 2).collect()}
    assert "stub:" in done["main.c:main"].prompt and "int area(int side)" in done["lib/shape_area.c:area"].prompt
    for kind in ("macro", "struct", "global_var"):
        assert A.entity_prompts(found, read[0], kind).count() >= 2
    assert "run_loop" in A.startup_prompt(found, read[0]).first().prompt
    assert "lib/shape_area.c" in A.module_prompts(found, read[0]).where("entity_key = 'shape'").first().prompt


def test_training(spark):
    docs = spark.createDataFrame([("struct", "k", "doc", "p", "x", "d"), ("function", "f", "doc", "p", "x", "d {name}")], "entity_kind string, entity_key string, stage string, path string, prompt string, response string")
    made = P.train_prompts(docs, spark.createDataFrame([("function", "f", "int f;")], "entity_kind string, entity_key string, source string"))
    assert sorted(r.entity_kind for r in made.collect()) == ["function", "struct"] and any("d {name}" in r.prompt and "int f;" in r.prompt for r in made.collect())
    answers = made.withColumn("response", F.lit("### Q: a\n### A: b\n---\n### Q: c\n### A: d\ne\n---"))
    assert {(r.question, r.answer) for r in P.samples(answers).collect()} == {("a", "b"), ("c", "d\ne")}


def test_command_line(project, tmp_path, spark):
    out = str(tmp_path / "out")
    assert cli.main([project, "--output", out]) == 0
    made = set(os.listdir(out))
    assert {"call_graph", "file_info", "struct_info", "macro_info", "global_var_info", "module_structure", "project_tree", "call_tree", "startup_vectors"} <= made
    assert cli.main([project, "--mode", "s_doc", "--output", out]) == 0 and cli.main([project, "--mode", "struct_train", "--output", out]) == 0
    assert any(n.endswith("_train.md") for _, _, names in os.walk(out) for n in names)


def test_tree(spark):
    tree = modules.path_tree(spark.createDataFrame([("a/b.c",), ("a/c/d.c",), ("z.c",)], "path string"), "path")
    assert [r.line for r in modules.tree_text(tree).collect()] == ["├── a", "│   ├── b.c", "│   └── c", "│       └── d.c", "└── z.c"]
    assert json.loads(sinks.tree_json(["a/b", "c"])) == {"a": {"b": {}}, "c": {}}


def test_conditionals():
    lines, found = cparse.preprocess("#if LEVEL > 2 && defined(A)\n#define X 1\n#elif 1\n#define Y 2\n#else\n#define Z 3\n#endif\nint a; // b\n", {"LEVEL": "3", "A": "1"})
    assert [f[1] for f in found] == ["X"] and lines[7].strip() == "int a;"
    assert [f[1] for f in cparse.preprocess("#ifndef G_H\n\n// x\n#define G_H\n#define REAL\n#endif\n")[1]] == ["REAL"]


def test_stream(spark, tmp_path):
    from factloom.streaming.incremental import document_stream

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    one = spark.createDataFrame([("f", "k1", "doc", "p", "x"), ("f", "k2", "doc", "p", "y")], "entity_kind string, entity_key string, stage string, path string, prompt string")
    one.write.parquet(src)
    document_stream(spark, src, out, str(tmp_path / "c"), P.OfflineStub()).awaitTermination()
    one.union(one.select("entity_kind", F.lit("k3"), "stage", "path", "prompt").limit(1)).write.mode("append").parquet(src)
    document_stream(spark, src, out, str(tmp_path / "c"), P.OfflineStub()).awaitTermination()
    assert sorted(r.entity_key for r in spark.read.parquet(out).collect()) == ["k1", "k2", "k3"]
