"""Token counts of a public tokenizer, for budgets of the real kind."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

TEXTS_PER_CALL = 256


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def counted_by(path: str) -> Callable[[Column], Column]:
    """A token counter by the tokenizer file at ``path``; special tokens' strings are plain text.

    For ``count_tokens`` of the embedding job. A NULL text has a NULL count.
    """

    @F.arrow_udf("int")
    def count(texts: pa.Array) -> pa.Array:
        encode = _tokenizer(path).encode_batch_fast
        values, out = texts.to_pylist(), []
        for first in range(0, len(values), TEXTS_PER_CALL):
            some = values[first : first + TEXTS_PER_CALL]
            found = iter(encode([t for t in some if t is not None], add_special_tokens=False))
            out += [None if t is None else len(next(found).ids) for t in some]
        return pa.array(out, pa.int32())

    return count
