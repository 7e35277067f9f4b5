"""Quality rules: line sequence labelling decides which documents stay.

Every line with a word gets shape features; a linear-chain conditional random field, fitted on a
bounded sample of ``labels``, marks it content or boilerplate by Viterbi decoding, and a document
stays when enough of its word bytes lie in content lines and no base rule rejects it.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chain, winnow
from .common import column, load_arrays, save_arrays, table

#: At most so many labelled documents, those of the smallest hashes of their ids, are fitted to.
SAMPLE_ROWS = 4000
#: Share of a document's word bytes that must lie in content lines.
CONTENT_SHARE = 0.5
SHORT_WORDS = 20
REPEAT_PERCENT = 30
REPEAT_WINDOW = 8

_BINS = (
    ("symbols per word", (0.02, 0.1, 0.3, 0.7, 1.5)),
    ("bars per word", (0.02, 0.1, 0.3, 0.7)),
    ("exclamation marks per word", (0.05, 0.2, 0.5, 1.0)),
    ("upper-case share of ASCII letters", (0.15, 0.35, 0.6, 0.9)),
    ("digits per byte", (0.02, 0.1, 0.3)),
    ("full stops and commas per word", (0.02, 0.08, 0.2)),
    ("bytes per word", (3.0, 5.0, 8.0, 14.0, 40.0)),
    ("share of repeated words", (0.01, 0.3, 0.8)),
    ("line equals an earlier one", (0.5,)),
    ("share of words equal to the one before", (0.1, 0.4)),
)
FEATURES = sum(len(edges) + 1 for _, edges in _BINS)


def _table(*chars: str) -> np.ndarray:
    t = np.zeros(256, np.int64)
    for c in "".join(chars):
        t[ord(c)] = 1
    return t


_SYMBOL, _BAR, _BANG = _table("#*$%&|<>"), _table("|"), _table("!")
_UPPER, _LETTER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_DIGIT, _STOP = _table("0123456789"), _table(".,")


class Lines(NamedTuple):
    doc: np.ndarray
    size: np.ndarray  #: word bytes
    features: np.ndarray
    first: np.ndarray


def measure(t: winnow.Texts) -> tuple[dict[str, np.ndarray], Lines]:
    """Base counts per document, and the lines that have a word."""
    docs, n = len(t.offsets) - 1, len(t.data)
    w = winnow.words(t)
    running = lambda x: np.concatenate([[0], np.cumsum(x)])
    inside = running(~winnow._SPACE[t.data])
    points = running(~winnow._SPACE[t.data] & ((t.data & 0xC0) != 0x80))
    symbols = running(_SYMBOL[t.data])
    per_doc = lambda c: c[t.offsets[1:]] - c[t.offsets[:-1]]

    hashes = winnow.word_hashes(t, w)
    stutter = np.zeros(len(hashes), bool)
    stutter[1:] = (hashes[1:] == hashes[:-1]) & (w.doc[1:] == w.doc[:-1])
    stutters = running(stutter)
    repeated = np.zeros(len(w.start), bool)
    if len(w.start) >= REPEAT_WINDOW:
        at = np.flatnonzero(w.doc[: len(w.doc) - REPEAT_WINDOW + 1] == w.doc[REPEAT_WINDOW - 1 :])
        h = winnow.sliding(hashes, REPEAT_WINDOW)[at]
        key = winnow.join(h, w.doc[at].astype(np.uint64))
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        again = at[count[which] > 1]
        repeated = winnow.covered(len(w.start), again, again + REPEAT_WINDOW)
    repeats = running(repeated)

    breaks = np.flatnonzero(t.data == 10) + 1
    start = np.sort(np.concatenate([t.offsets[:-1], breaks]))
    doc = np.searchsorted(t.offsets, start, side="right") - 1
    fresh = np.concatenate([t.offsets[:-1], breaks])
    order = np.argsort(fresh, kind="stable")
    is_break = order >= docs
    start, doc = fresh[order], np.concatenate([np.arange(docs), np.searchsorted(t.offsets, breaks - 1, side="right") - 1])[order]
    by = np.lexsort((is_break, start, doc))
    start, doc = start[by], doc[by]
    end = np.concatenate([start[1:] - 1, [n]]) if len(start) else start
    new_doc = np.concatenate([doc[1:] != doc[:-1], [True]]) if len(doc) else np.zeros(0, bool)
    end = np.where(new_doc, t.offsets[1:][doc], end) if len(doc) else end
    keep = inside[end] > inside[start]
    start, end, doc = start[keep], end[keep], doc[keep]
    if len(start):
        key = winnow.join(winnow.range_hashes(t.data, start, end), doc.astype(np.uint64))
        _, once = np.unique(key, return_index=True)
        again = np.ones(len(start), bool)
        again[once] = False
    else:
        again = np.zeros(0, bool)

    a, b = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    words = np.maximum(b - a, 1)
    between = lambda kind: (c := running(kind[t.data]))[end] - c[start]
    size = inside[end] - inside[start]
    values = (
        between(_SYMBOL) / words,
        between(_BAR) / words,
        between(_BANG) / words,
        between(_UPPER) / np.maximum(between(_LETTER), 1),
        between(_DIGIT) / np.maximum(size, 1),
        between(_STOP) / words,
        size / words,
        words,
        (repeats[b] - repeats[a]) / words,
        again,
        (stutters[b] - stutters[a]) / words,
    )
    features, base = np.zeros((len(start), len(_BINS)), np.int64), 0
    for i, ((_, edges), v) in enumerate(zip(_BINS, values)):
        features[:, i] = base + np.searchsorted(edges, v, side="right")
        base += len(edges) + 1
    counts = {
        "n_words": np.diff(w.first),
        "word_chars": per_doc(points),
        "n_symbols": per_doc(symbols),
        "n_dup_lines": np.bincount(doc, again, docs).astype(np.int64),
        "n_repeat_words": repeats[w.first[1:]] - repeats[w.first[:-1]],
    }
    return counts, Lines(doc, size, features, np.searchsorted(doc, np.arange(docs + 1)))


class Model(NamedTuple):
    weights: np.ndarray  #: (features, 2): content, boilerplate
    transition: np.ndarray


#: Used where no sample of both classes exists: every line is content.
NO_MODEL = Model(np.tile([[0.1, 0.0]], (FEATURES + 1, 1)), np.zeros((2, 2)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit the field on all lines of at most ``sample_rows`` labelled documents; lines take their document's label."""
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label_col).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id", F.lit(17)), "_id")
        .limit(sample_rows)
    )
    # The sample has a fixed bound of rows of two integers, so it may be broadcast.
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    # Of rows with one id one text is taken, so their number is bounded too.
    rows = rows.groupBy("_id", "_label").agg(F.min("_text").alias("_text")).select("_id", "_text", "_label")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in winnow.pieces(batch, "_text"):
                _, found = measure(winnow.texts(column(part, "_text")))
                label = column(part, "_label").to_numpy()
                rows = [found.features[a:b].ravel() for a, b in zip(found.first[:-1], found.first[1:])]
                yield pa.RecordBatch.from_arrays([column(part, "_id"), pa.array(label, pa.int32()), pa.array(rows, pa.list_(pa.int64()))], ["_id", "_label", "f"])

    got = rows.mapInArrow(lines, "_id long, _label int, f array<long>").toPandas()
    got = got[got.f.map(len) > 0].sort_values("_id", kind="stable")
    if got._label.nunique() < 2:
        return NO_MODEL
    parts = [np.asarray(x).reshape(-1, len(_BINS)) for x in got.f]
    lengths = np.array([len(p) for p in parts])
    labelled = np.repeat(1 - got._label.to_numpy(), lengths)
    weights, transition = chain.fit(np.concatenate(parts), (FEATURES, 2), labelled, np.concatenate([[0], np.cumsum(lengths)]), rounds=150, rate=0.1, l2=1e-5)
    return Model(weights, transition)


def save(spark: SparkSession, model: Model, path: str) -> None:
    """Write a fitted model to the shared folder, so that later jobs needn't fit it again."""
    save_arrays(spark, path, weights=model.weights, transition=model.transition)


def load(spark: SparkSession, path: str) -> Model:
    found = load_arrays(spark, path)
    return Model(found["weights"], found["transition"])


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep_columns: tuple[str, ...] = (), content_share: float = CONTENT_SHARE) -> DataFrame:
    """Base counts, verdict and content share of every document, in one pass without a shuffle.

    Null or empty text: all counts 0, no lines, content_share 0, rejected by the base rule.  Repeated
    rows are judged one by one and alike.  A null id is kept as it is.  ``keep_columns`` pass through;
    columns of the same names as the results are not needed and not read.
    """
    narrow = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"_k_{c}") for c in keep_columns])
    kept_fields = [f for f in narrow.schema.fields if f.name.startswith("_k_")]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    weights, transition = model

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in winnow.pieces(batch, "_text"):
                counts, lines = measure(winnow.texts(column(part, "_text")))
                emission = weights[lines.features].sum(axis=1)
                content = chain.viterbi(emission, transition, lines.first) == 0
                docs_n = part.num_rows
                total = np.bincount(lines.doc, lines.size, docs_n)
                share = np.bincount(lines.doc, lines.size * content, docs_n) / np.maximum(total, 1)
                failed = (counts["n_words"] < SHORT_WORDS) | (100 * counts["n_repeat_words"] > REPEAT_PERCENT * counts["n_words"])
                arrays = [column(part, "_id"), *[pa.array(counts[c].astype(np.int64)) for c in names], pa.array(failed), pa.array(~failed & (share >= content_share)), pa.array(share)]
                arrays += [column(part, f.name) for f in kept_fields]
                yield pa.RecordBatch.from_arrays(arrays, ["_id", *names, "base_failed", "kept", "content_share", *[f.name for f in kept_fields]])

    schema = narrow.select("_id").schema
    for c in names:
        schema = schema.add(c, "long")
    schema = schema.add("base_failed", "boolean").add("kept", "boolean").add("content_share", "double")
    for f in kept_fields:
        schema = schema.add(f)
    out = narrow.mapInArrow(judge, schema)
    return out.select(F.col("_id").alias(id_col), *names, "base_failed", "kept", "content_share", *[F.col(f"_k_{c}") for c in keep_columns])


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op10: all documents, with a model fitted on the labelled sample."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns only.

    Null and empty texts go, as the base rule rejects them; repeated rows and rows with null ids are
    judged one by one; columns need no special names, and an empty table gives an empty one.
    """
    names = docs.columns
    scored = score_quality(docs, fit(docs, labels), keep_columns=tuple(names))
    return scored.where("kept").select(*[F.col(f"_k_{c}").alias(c) for c in names])
