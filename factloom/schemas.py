"""Fixed schemas of the fact tables."""

from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


EDGES = _schema("caller_file string, caller string, callee_file string, callee string, ord int")
FUNCTIONS = _schema("file string, name string, defined_in string, start_line int, end_line int")
CALLS = _schema("file string, caller string, callee string, ord int")
INCLUDES = _schema("file string, included string, quoted boolean, ord int")
TYPES = _schema("kind string, name string, defined_in string, start_line int, end_line int")
TYPE_FIELDS = _schema("type_name string, parent_path string, ordinal int, name string, type_text string, nested_kind string, defined_in string")
ENUM_VALUES = _schema("type_name string, ordinal int, name string, value bigint, defined_in string")
TYPE_USES = _schema("name string, use_file string, use_function string")
TYPEDEFS = _schema("file string, alias string, target string")
MACROS = _schema("name string, params string, content string, defined_in string, line int")
MACRO_USES = _schema("name string, use_file string, use_function string")
GLOBALS = _schema("name string, type_text string, defined_in string, is_definition boolean")
GLOBAL_USES = _schema("name string, use_file string, use_function string")
MODULES = _schema("module string, ord int, file string")
MODULE_DEPS = _schema("module string, dependency string")
SOURCE_LINES = _schema("file string, line_no int, text string")
STARTUP_EXPORTS = _schema("name string, is_weak boolean")
STARTUP_VECTORS = _schema("index int, handler string")
PROMPTS = _schema("entity_kind string, entity_key string, stage string, path string, prompt string, response string")
