"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, language, minhash, mixing, quality, secrets, substring, suffix, vectors, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": warc.warc,
    "op2_substring": substring.substring,
    "op3_bpe": bpe.bpe,
    "op4_secrets": secrets.secrets,
    "op5_vectors": vectors.vectors,
    "op6_mixing": mixing.mixing,
    "op7_minhash": minhash.minhash,
    "op8_suffix": suffix.suffix,
    "op9_language": language.language,
    "op10_quality": quality.quality,
}

ORACLES: dict[str, str] = {
    "op1_warc": warc.SQL,
    "op2_substring": substring.SQL,
    "op4_secrets": secrets.SQL,
    "op6_mixing": mixing.SQL,
    "op7_minhash": minhash.SQL,
    "op8_suffix": suffix.SQL,
}
