"""Language of documents by a linear-chain conditional random field over words.

A word's emission adds weights of its lexicon entry, its affixes and its byte n-grams; transitions
between the labels of neighbouring words are learned on code-switched sequences, spliced from spans
of labelled documents.  Forward-backward gives every word's label distribution; a document takes the
label with the largest mean, and that mean as its score.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import chain, winnow
from .common import column, load_arrays, save_arrays, table

#: The fit uses at most so many documents of each language, by hash of their ids, and of longer ones so
#: many words in SPANS pieces that are spread evenly over the whole text.
SAMPLE_DOCS, SAMPLE_WORDS, SPANS = 300, 400, 10
#: Hashed weights of lexicon and affixes, and of n-grams.
WORD_BITS, GRAM_BITS = 17, 16
ROUNDS = 30
_GRAM = 3
_AFFIXES = ((2, True), (3, True), (4, True), (2, False), (3, False), (4, False))
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ANY_LETTER = regex.compile(r"\p{L}")


def held_out(id_col: str) -> Column:
    """Documents that nothing is learned from; a null id is not held out, but nothing is learned from it."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


class Features(NamedTuple):
    first: np.ndarray  #: words with a letter of document i are first[i]:first[i + 1]
    words: np.ndarray  #: (words, 1 + affixes) indices
    grams: np.ndarray  #: index per byte
    begin: np.ndarray  #: first gram of a word
    end: np.ndarray  #: behind its last gram


def features(t: winnow.Texts) -> Features:
    data = t.data.copy()
    upper = (data >= 65) & (data <= 90)
    data[upper] += 32
    # Latin-1 capitals in UTF-8: C3 80 to C3 9E, but for the multiplication sign.
    lead = np.zeros(len(data), bool)
    lead[1:] = t.data[:-1] == 0xC3
    data[lead & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 0x20
    folded = winnow.Texts(data, t.offsets)
    w = winnow.words(folded)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    keep = letters[w.end] > letters[w.start]
    start, end, doc = w.start[keep], w.end[keep], w.doc[keep]
    mask = np.uint64((1 << WORD_BITS) - 1)
    out = [winnow.range_hashes(data, start, end) & mask]
    view = winnow.loads(data)
    for i, (size, front) in enumerate(_AFFIXES):
        a = start if front else np.maximum(end - size, start)
        b = np.minimum(start + size, end) if front else end
        some = view[a] & ((np.uint64(1) << (np.uint64(8) * (b - a).astype(np.uint64))) - np.uint64(1))
        out.append(winnow.mix(some * np.uint64(8) + np.uint64(i + 1)) & mask)
    grams = view[:-1] & np.uint64((1 << 8 * _GRAM) - 1)
    grams = (winnow.mix(grams) & np.uint64((1 << GRAM_BITS) - 1)).astype(np.int64)
    first = np.searchsorted(doc, np.arange(len(t.offsets)))
    return Features(first, np.stack(out, 1).astype(np.int64), grams, start, np.maximum(end - _GRAM + 1, start))


class Model(NamedTuple):
    labels: list[str]
    words: np.ndarray
    grams: np.ndarray
    transition: np.ndarray


def emissions(f: Features, m: Model) -> np.ndarray:
    total = np.zeros((len(f.grams) + 1, len(m.labels)))
    np.cumsum(m.grams[f.grams], axis=0, out=total[1:])
    mean = (total[f.end] - total[f.begin]) / np.maximum(f.end - f.begin, 1)[:, None]
    out = 4.0 * mean
    for c in range(f.words.shape[1]):
        out += m.words[f.words[:, c]]
    return out


def fit(texts: list[str], langs: list[str], rounds: int = ROUNDS) -> Model | None:
    """Adam on the likelihood of spliced sequences; half of the lexicon entries are left out in each round."""
    labels = sorted(set(langs))
    if not labels:
        return None
    rng = np.random.default_rng(11)
    f = features(winnow.texts(pa.array(texts, pa.large_string())))
    n, count = len(f.words), len(labels)
    doc = np.repeat(np.arange(len(texts)), np.diff(f.first))
    truth_all = np.array([labels.index(x) for x in langs])[doc]
    # Spans of 3 to 40 words in random order: neighbours differ in language now and then.
    cuts = [0]
    while cuts[-1] < n:
        cuts.append(min(n, cuts[-1] + int(rng.integers(3, 40))))
    spans = np.array(sorted(set(cuts) | set(f.first.tolist())))
    spans = np.stack([spans[:-1], spans[1:]], 1)
    order = np.concatenate([np.arange(a, b) for a, b in spans[rng.permutation(len(spans))]]) if n else np.zeros(0, np.int64)
    first = np.unique(np.concatenate([np.arange(0, n, 200), [n]]))
    truth = truth_all[order]
    words = f.words[order]
    length = (f.end - f.begin)[order]
    gram_word = np.repeat(np.arange(n), length)
    gram_at = np.repeat(f.begin[order], length) + np.arange(len(gram_word)) - np.repeat(np.cumsum(length) - length, length)
    gram = f.grams[gram_at]
    share = 4.0 / np.maximum(length, 1)
    x = [np.zeros((1 << WORD_BITS, count)), np.zeros((1 << GRAM_BITS, count)), np.zeros((count, count))]
    seen = np.zeros((count, count))
    inner = np.ones(n, bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    np.add.at(seen, (truth[at - 1], truth[at]), 1)
    one = np.eye(count)[truth]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in x]
    for r in range(1, rounds + 1):
        on = np.ones(words.shape)
        on[:, 0] = rng.random(n) < 0.5
        e = np.zeros((n, count))
        for c in range(words.shape[1]):
            e += x[0][words[:, c]] * on[:, c, None]
        for k in range(count):
            e[:, k] += share * np.bincount(gram_word, x[1][gram, k], n)
        post, pairs = chain.posteriors(e, x[2], first)
        error = one - post
        flat, weight = words.ravel(), on.ravel()
        g0 = np.stack([np.bincount(flat, weight * np.repeat(error[:, k], words.shape[1]), 1 << WORD_BITS) for k in range(count)], 1)
        g1 = np.stack([np.bincount(gram, (error[:, k] * share)[gram_word], 1 << GRAM_BITS) for k in range(count)], 1)
        for i, g in enumerate((g0 / n - 1e-6 * x[0], g1 / n - 1e-6 * x[1], (seen - pairs) / n - 1e-4 * x[2])):
            a, b = moments[i]
            a *= 0.9
            a += 0.1 * g
            b *= 0.99
            b += 0.01 * g * g
            x[i] += 0.1 * (a / (1 - 0.9**r)) / (np.sqrt(b / (1 - 0.99**r)) + 1e-7)
    return Model(labels, x[0].astype(np.float32), x[1].astype(np.float32), x[2])


def save(spark: SparkSession, model: Model, path: str) -> None:
    """Write a fitted model to the shared folder, so that later jobs needn't fit it again."""
    save_arrays(spark, path, labels=np.array(model.labels), words=model.words, grams=model.grams, transition=model.transition)


def load(spark: SparkSession, path: str) -> Model:
    found = load_arrays(spark, path)
    return Model([str(x) for x in found["labels"]], found["words"], found["grams"], found["transition"])


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], list[str]]:
    """Bounded: SAMPLE_DOCS documents of each language, SAMPLE_WORDS words of each, from all over its text.

    Of rows with one id and language one text is taken, the smallest.
    """
    usable = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    keyed = usable.select(F.col(lang_col).alias("lang"), F.struct(F.xxhash64(id_col, F.lit(23)).alias("h"), F.col(id_col).alias("id")).alias("k"))
    # The smallest hashes of each language, kept small in every partition before they are merged.
    per = keyed.withColumn("part", F.pmod(F.col("k.h"), F.lit(64)))
    some = per.withColumn("r", F.row_number().over(Window.partitionBy("lang", "part").orderBy("k"))).where(F.col("r") <= SAMPLE_DOCS // 32)
    chosen = some.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("part", "k"))).where(F.col("r") <= SAMPLE_DOCS).select("lang", F.col("k.id").alias("id"))
    # Bounded rows of two values, so it may be broadcast.
    rows = usable.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("t")).join(F.broadcast(chosen), ["id", "lang"])
    words = F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    size = SAMPLE_WORDS // SPANS
    last = F.size("w") - size
    spans = F.transform(F.sequence(F.lit(0), F.lit(SPANS - 1)), lambda i: F.slice("w", F.floor(i * last / (SPANS - 1)).cast("int") + 1, size))
    cut = F.when(F.size("w") <= SAMPLE_WORDS, F.col("w")).otherwise(F.flatten(spans))
    rows = rows.select("id", "lang", words.alias("w")).select("id", "lang", F.array_join(cut, " ").alias("t"))
    # Repeated ids may be many, so they meet before anything is sent to the driver.
    got = sorted((r["id"], r["lang"], r["t"]) for r in rows.groupBy("id", "lang").agg(F.min("t").alias("t")).collect())
    return [x[2] for x in got], [x[1] for x in got]


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) of every whole text, from the text alone.

    Null texts and texts without a letter are ``und`` with score 0, and so is everything without a
    model.  Repeated rows are predicted one by one and alike.
    """
    narrow = docs.select(F.col(id_col).alias("_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("_text"))
    session = docs.sparkSession.sparkContext
    shared = session.broadcast(model)  # its size is fixed by the bits and the number of labels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in winnow.pieces(batch, "_text", 1 << 20):
                n = part.num_rows
                pred, score = np.full(n, "und", object), np.zeros(n)
                if m is not None:
                    t = winnow.texts(column(part, "_text"))
                    f = features(t)
                    counts = np.diff(f.first)
                    mean = chain.posterior_sums(emissions(f, m), m.transition, f.first) / np.maximum(counts, 1)[:, None]
                    ascii_letters = np.concatenate([[0], np.cumsum(_LETTER[t.data] & (t.data < 128))])
                    sure = ascii_letters[t.offsets[1:]] > ascii_letters[t.offsets[:-1]]
                    for i in np.flatnonzero(counts):
                        if sure[i] or _ANY_LETTER.search(column(part, "_text")[int(i)].as_py()):
                            best = int(mean[i].argmax())
                            pred[i], score[i] = m.labels[best], min(1.0, float(mean[i, best]))
                yield pa.RecordBatch.from_arrays([column(part, "_id"), column(part, "held_out"), pa.array(pred, pa.string()), pa.array(score)], ["_id", "held_out", "lang_pred", "score"])

    schema = T.StructType([*narrow.select("_id", "held_out").schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return narrow.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op9: all documents."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(*sample(docs)))
