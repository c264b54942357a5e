"""Sizes of whole texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A byte-level BPE rank file; it must lie at this path on every executor.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of such rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_loaded: dict = {}


def encoder(path: str = VOCABULARY):
    """The tokenizer of a rank file, loaded once in a Python process."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def count_tokens(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of the whole text; 0 for an empty one, null for null."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path)
        for s in batches:
            yield pd.Series([None if t is None else len(e.encode_ordinary(t)) for t in s], dtype="Int64")

    return of(text)
