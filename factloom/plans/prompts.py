"""Prompts, completions and training samples as tables."""

from __future__ import annotations

import hashlib
import json
import logging
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import relational as R

TEMPLATES = {
    ("function", "doc"): "Describe the C function {name}.\n\nSource:\n{source}\n\nIt calls:\n{callees}\n\nWhat is known of these:\n{callee_docs}\n\nIt is called by:\n{callers}\n",
    ("macro", "doc"): "Describe the C macro below, defined in {file}.\n\n{definition}\n\nSurroundings:\n{context}\n\nUsed by:\n{users}\n\nExamples:\n{examples}\n",
    ("struct", "doc"): "Describe the C type {name}, defined in {file}.\n\n{definition}\n\nFacts: {facts}\n\nUsed by:\n{users}\n\nUsers' sources:\n{examples}\n",
    ("global_var", "doc"): "Describe the C variable {name}, defined in {file}.\n\nFacts: {facts}\n\nUsed by:\n{users}\n\nUsers' sources:\n{examples}\n",
    ("module", "doc"): "Describe the module {name}.\n\nFacts: {facts}\n\nIt depends on:\n{dependencies}\n\nWhat is known of these:\n{dependency_docs}\n\nSources:\n{source}\n",
    ("startup", "doc"): "Describe how the program starts.\n\nCall tree: {tree}\n\nmain:\n{main}\n\nCalled from main:\n{called}\n\nMain loop {loop_name} in {loop_file}:\n{loop}\n",
    ("function", "train"): "Write questions and answers on this function.\n\n{doc}\n\n{source}\n",
    ("macro", "train"): "Write questions and answers on this macro.\n\n{doc}\n\n{source}\n",
    ("struct", "train"): "Write questions and answers on this type.\n\n{doc}\n",
    ("global_var", "train"): "Write questions and answers on this variable.\n\n{doc}\n",
    ("module", "train"): "Write questions and answers on this module.\n\n{doc}\n",
    ("startup", "train"): "Write questions and answers on the program's start.\n\n{doc}\n",
}


class Completer(Protocol):
    """Anything that answers prompts in batches (U1, U2); it is pickled to the executors."""

    def __call__(self, prompts: list[str]) -> list[str | None]: ...


class OfflineStub:
    """A deterministic answer without a network."""

    def __call__(self, prompts: list[str]) -> list[str | None]:
        return [None if p is None else "stub:" + hashlib.md5(p.encode("utf-8", "surrogatepass")).hexdigest() for p in prompts]


class ChatCompleter:
    """A service with the usual chat-completions interface (U1, U2), asked over HTTP from the executors.

    Busy and failing answers are tried again with growing pauses; a prompt that fails for good is logged
    and gets null, so one bad prompt never stops a table.  A missing or placeholder key asks nothing.
    """

    def __init__(self, url: str, key: str | None, model: str, timeout: float = 120, tries: int = 4, pause: float = 1, **settings):
        self.url, self.key, self.model, self.timeout, self.tries, self.pause, self.settings = url, key, model, timeout, tries, pause, settings

    def __call__(self, prompts: list[str | None]) -> list[str | None]:
        usable = self.key and not self.key.lower().startswith("your")
        return [self.one(p) if usable and p is not None else None for p in prompts]

    def one(self, prompt: str) -> str | None:
        body = {"model": self.model, "messages": [{"role": "user", "content": prompt}], **self.settings}
        request = urllib.request.Request(self.url.rstrip("/") + "/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        for i in range(self.tries):
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                    choices = json.loads(reply.read()).get("choices") or [{}]
                    return (choices[0].get("message") or {}).get("content")
            except (urllib.error.URLError, TimeoutError, ValueError, OSError) as e:
                final = isinstance(e, urllib.error.HTTPError) and e.code not in (408, 429) and e.code < 500
                if final or i + 1 == self.tries:
                    logging.getLogger("factloom").warning("no completion: %s", e)
                    return None
                time.sleep(self.pause * 2**i)
        return None


def completer(settings: dict) -> Completer:
    """The configured service, or the offline stub where none is named."""
    if not settings.get("base_url"):
        return OfflineStub()
    extra = {k: settings[k] for k in ("temperature", "max_tokens", "top_p", "frequency_penalty", "presence_penalty") if k in settings}
    return ChatCompleter(settings["base_url"], settings.get("api_key"), settings.get("model", "default"), **extra)


def render(rows: DataFrame, kind: str, stage: str, key: Column, path: Column, **values: Column) -> DataFrame:
    """Prompt rows of one kind and stage."""
    prompt = X.template(TEMPLATES[kind, stage], **{k: X.or_default(v.cast("string"), "none") for k, v in values.items()})
    return rows.select(F.lit(kind).alias("entity_kind"), key.alias("entity_key"), F.lit(stage).alias("stage"), path.alias("path"), prompt.alias("prompt"))


def complete(prompts: DataFrame, completer: Completer, workers: int | None = None, batch: int = 32) -> DataFrame:
    """Responses (U1-U3): ``workers`` partitions call at a time, zero-width characters are trimmed.

    Of what Spark hands over, only ``batch`` prompts are Python strings at a time, and their rows go on at once.
    """
    from pyspark.sql import types as T

    rows = prompts if workers is None else prompts.repartition(workers)
    schema = T.StructType([*prompts.schema.fields, T.StructField("response", T.StringType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for i in range(0, given.num_rows, batch):
                some = given.slice(i, batch)
                answers = completer(some.column(names.index("prompt")).to_pylist())
                response = pa.array([None if a is None else a.strip(X.ZERO_WIDTH) for a in answers], pa.string())
                yield pa.RecordBatch.from_arrays([*some.columns, response], names)
            given = some = None  # else they stay while the next are read

    return rows.mapInArrow(run, schema)


def document(prompts: DataFrame, done: DataFrame | None, completer: Completer, workers: int | None = None) -> DataFrame:
    """New entities only (K12, A7): one prompt per key, none that is done."""
    rows = R.first_by(prompts, ["entity_kind", "stage", "entity_key"], ["path", "prompt"])
    if done is not None:
        rows = R.not_done(rows, done, ["entity_kind", "stage", "entity_key"])
    return complete(rows, completer, workers)


def train_prompts(docs: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Training prompts from documents (S24, J14, U5); functions and macros come with their source."""
    out = None
    for kind in ("function", "macro", "struct", "global_var", "module", "startup"):
        rows = docs.where((F.col("entity_kind") == kind) & (F.col("stage") == "doc") & F.col("response").isNotNull())
        source = F.lit(None).cast("string")
        if kind in ("function", "macro") and sources is not None:
            rows = rows.join(sources.where(F.col("entity_kind") == kind).select("entity_key", "source"), "entity_key", "left")
            source = F.col("source")
        path = F.concat(F.lit("train/"), F.col("path"))
        values = {"doc": F.col("response")} | ({"source": source} if kind in ("function", "macro") else {})
        made = render(rows, kind, "train", F.col("entity_key"), path, **values)
        out = made if out is None else out.union(made)
    return out


def samples(responses: DataFrame) -> DataFrame:
    """(entity_kind, entity_key, question, answer) of training responses."""
    rows = responses.where("stage = 'train'").select("entity_kind", "entity_key", F.explode(X.split_samples("response")).alias("s"))
    return rows.select("entity_kind", "entity_key", "s.question", "s.answer")
