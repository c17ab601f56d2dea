"""Sizes of texts in tokens of a public tokenizer.

The vocabulary file is read on the executors; its path is a parameter. Each worker loads it once.
Null texts have size null, empty ones 0. Whole texts are counted.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A byte-level BPE for many languages. Overridden by LAMINA_VOCABULARY.
VOCABULARY = os.environ.get("LAMINA_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: How the public byte-level BPE splits text before merging. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LOADED: dict[str, object] = {}


def encoding(path: str) -> object:
    """The tokenizer of a .tiktoken vocabulary, once per process."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _LOADED[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def count(text: Column, path: str = VOCABULARY) -> Column:
    """Number of tokens."""

    @F.pandas_udf("long")
    def size(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path)
        for texts in batches:
            yield pd.Series([None if t is None else len(enc.encode_ordinary(t)) for t in texts], dtype="Int64")

    return size(text)
