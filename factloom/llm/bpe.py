"""BPE encoding and decoding over a distinct-word table.

Texts are cut at white space; the tokenizer's own normalisation and splitting never reach across it,
so a word's ids don't depend on its neighbours.  Documents are packed into blocks, and a block holds
its words once, as positions into its own word list.  The lists, hashed into word partitions and
compressed, meet in one task per partition: there each distinct word of the corpus is encoded once.
The ids travel back per block and are joined to the words by position.  Decoding looks ids up in the
id-to-piece table, whose size is the vocabulary's.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
import zlib
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, partitions, size_in_bytes, table
from .winnow import pieces

#: White space as the tokenizer's normaliser sees it; other control characters belong to words.
SPACES = "\t-\r \x85\xa0  -     　"
#: Bytes of text in a block, unless one document alone has more.
BLOCK_BYTES = 8 << 20
#: Bytes of input for each word partition, and the most of these.
PART_BYTES, MOST_PARTS = 64 << 20, 8192
_RUN = re.compile(f"[^{SPACES}]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(2)
def _pieces(path: str) -> dict[int, str]:
    t = _tokenizer(path)
    if t.decoder is not None:
        raise ValueError("a tokenizer with a decoder joins pieces in its own way")
    return {i: piece for piece, i in t.get_vocab(with_added_tokens=True).items()}


def _pack(*parts: bytes) -> bytes:
    sizes = np.array([len(parts), *map(len, parts)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(sizes + b"".join(parts))


def _unpack(blob: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, count, 8)
    ends = 8 * (count + 1) + np.cumsum(sizes)
    return [raw[e - s : e] for s, e in zip(sizes, ends)]


def _planes(codes: np.ndarray) -> bytes:
    """The four bytes of each number, plane by plane: small numbers leave long runs of zeros."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def blocks(docs: DataFrame, id_col: str, text_col: str, parts: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, ids, body): documents' words as positions into the block's word lists, one list per hash.

    body holds: words per document, a code per word (0 for the most frequent), each code's place in
    the lists laid end to end, and then the lists themselves.
    """
    narrow = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = narrow.schema["_id"].dataType

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in pieces(batch, "_text", block_bytes):
                seen: dict[str, int] = {}
                codes, lengths = [], []
                for text in column(piece, "_text").to_pylist():
                    found = _RUN.findall(text) if text else []
                    lengths.append(len(found))
                    codes.extend([seen.setdefault(x, len(seen)) for x in found])
                lists: list[list[str]] = [[] for _ in range(parts)]
                for x in sorted(seen):
                    lists[zlib.crc32(x.encode("utf-8", "surrogatepass")) % parts].append(x)
                place = np.empty(len(seen), np.int64)
                place[np.fromiter((seen[x] for some in lists for x in some), np.int64, len(seen))] = np.arange(len(seen))
                code = np.array(codes, np.int64)
                order = np.argsort(-np.bincount(code, minlength=len(seen)), kind="stable")
                rank = np.empty(len(seen), np.int64)
                rank[order] = np.arange(len(seen))
                words = [_pack("\n".join(x).encode("utf-8", "surrogatepass")) if x else b"" for x in lists]
                head = _pack(np.array(lengths, np.int64).tobytes(), _planes(rank[code]), _planes(place[order]))
                body = b"".join([np.array([len(x) for x in (head, *words)], np.int64).tobytes(), head, *words])
                ids = pa.ListArray.from_arrays(pa.array([0, piece.num_rows], pa.int32()), column(piece, "_id"))
                yield pa.RecordBatch.from_arrays([pa.array([(task << 32) | made]), ids, pa.array([body], pa.binary())], ["block", "ids", "body"])
                made += 1

    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)), T.StructField("body", T.BinaryType())])
    return narrow.mapInArrow(pack, schema)


def _cut(body: bytes, parts: int) -> list[bytes]:
    """Of a body its head and its lists."""
    sizes = np.frombuffer(body, np.int64, parts + 1)
    ends = 8 * (parts + 1) + np.cumsum(sizes)
    return [body[e - n : e] for n, e in zip(sizes, ends)]


def _lists(parts: int):
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body in zip(column(batch, "block").to_pylist(), column(batch, "body").to_pylist()):
                found = [(p, x) for p, x in enumerate(_cut(body, parts)[1:]) if x]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(found), pa.int64()), pa.array([p for p, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], ["block", "part", "list"])

    return lists


def _encode_lists(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one word partition follow each other; the word table is kept while it lasts."""
        tokenizer, part, known = _tokenizer(path), None, {}
        for batch in batches:
            blobs = []
            for p, blob in zip(column(batch, "part").to_pylist(), column(batch, "list").to_pylist()):
                if p != part:
                    part, known = p, {}
                words = _unpack(blob)[0].decode("utf-8", "surrogatepass").split("\n")
                new = [x for x in words if x not in known]
                for i in range(0, len(new), 4096):
                    some = new[i : i + 4096]
                    for x, e in zip(some, tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                        known[x] = np.array(e.ids, np.int32).tobytes()
                got = [known[x] for x in words]
                blobs.append(_pack(np.array([len(x) // 4 for x in got], np.int32).tobytes(), b"".join(got)))
            yield pa.RecordBatch.from_arrays([column(batch, "block"), column(batch, "part"), pa.array(blobs, pa.binary())], ["block", "part", "encoded"])

    return encode


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, ids array<int>, decoded string) of every document, repeated rows and null ids included.

    Null and empty texts have no ids and decode to the empty string.  Other columns are not read.
    """
    spark = docs.sparkSession
    path = path or default_path()
    # Each word partition serves some input, so none grows with the corpus; a block has tens of thousands
    # of words, and more partitions than MOST_PARTS would leave it a few for each.
    parts = parts or int(min(MOST_PARTS, max(2 * partitions(spark), size_in_bytes(docs.select(text_col)) // PART_BYTES)))
    # Both uses read all columns, so that one shuffle of the blocks serves them.
    made = blocks(docs, id_col, text_col, parts, block_bytes).repartition(partitions(spark), "block")
    id_type = made.schema["ids"].dataType.elementType
    lists = made.mapInArrow(_lists(parts), "block long, part int, list binary")
    lists = lists.repartition(parts, "part").sortWithinPartitions("part", "block")
    coded = lists.mapInArrow(_encode_lists(path), "block long, part int, encoded binary")
    back = coded.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("part", "encoded"))).alias("lists"))
    joined = made.join(back.select("block", "lists.encoded"), "block", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = _pieces(path)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = column(batch, "ids")[row].values
                raw = _unpack(_cut(column(batch, "body")[row].as_py(), parts)[0])
                lengths, codes = np.frombuffer(raw[0], np.int64), _numbers(raw[2])[_numbers(raw[1])]
                got = [_unpack(x) for x in column(batch, "encoded")[row].as_py() or []]
                counts = np.frombuffer(b"".join(x[0] for x in got), np.int32).astype(np.int64)
                flat = np.frombuffer(b"".join(x[1] for x in got), np.int32)
                begin = np.cumsum(counts) - counts
                texts = [" ".join([name[i] for i in flat[b : b + c].tolist()]) for b, c in zip(begin.tolist(), counts.tolist())]
                first = np.concatenate([[0], np.cumsum(lengths)])
                at = 0
                while at < len(lengths):
                    # Some documents at a time: about a million words, or one document.
                    to = max(at + 1, int(np.searchsorted(first, first[at] + (1 << 20), side="right")) - 1)
                    part = codes[first[at] : first[to]]
                    n = counts[part]
                    ends = np.concatenate([[0], np.cumsum(n)])
                    values = flat[np.repeat(begin[part] - ends[:-1], n) + np.arange(ends[-1])] if len(part) else flat[:0]
                    offsets = ends[first[at : to + 1] - first[at]]
                    listed = part.tolist()
                    cuts = (first[at : to + 1] - first[at]).tolist()
                    # A word without ids adds neither a piece nor a space.
                    decoded = [" ".join([x for c in listed[a:b] if (x := texts[c])]) for a, b in zip(cuts, cuts[1:])]
                    yield pa.RecordBatch.from_arrays([ids.slice(at, to - at), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32())), pa.array(decoded, pa.string())], ["_id", "ids", "decoded"])
                    at = to

    schema = T.StructType([T.StructField("_id", id_type), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return joined.mapInArrow(finish, schema).withColumnRenamed("_id", id_col)


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op3: all documents."""
    return digests(encode(table(spark, sf_dir, "documents")))
