"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A byte-level vocabulary for many languages, as ranks, where the session names no other.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Session setting that names another vocabulary file of the kind; the driver reads it.
SETTING = "spark.tallymark.vocabulary"
# Fixed value: the public pre-tokenization pattern of byte-level vocabularies of this kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ENCODERS: dict[int, object] = {}


def encoder(ranks: bytes):
    """The encoder of a vocabulary, made once per Python worker."""
    key = hash(ranks)
    if key not in _ENCODERS:
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        _ENCODERS[key] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
    return _ENCODERS[key]


def with_token_counts(df: DataFrame, text: str, vocabulary: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns with n_tokens, the tokens of the whole text; null for a null text.

    The vocabulary, under 1 MB, is the file ``vocabulary``, else that of the session's SETTING,
    else VOCABULARY. It is read once by the driver and broadcast.
    """
    spark = df.sparkSession
    vocabulary = vocabulary or spark.conf.get(SETTING, VOCABULARY)
    ranks = spark.sparkContext.broadcast(Path(vocabulary).read_bytes())
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    src = df.select(*keep, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks.value)
        for batch in batches:
            n = [None if t is None else len(enc.encode_ordinary(t)) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n, pa.int64())], names=[*keep, "n_tokens"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(run, f"{schema}, n_tokens bigint")
