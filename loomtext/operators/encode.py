"""Encoding with a trained tokenizer, batch by batch, and the end token that goes with it."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: End tokens by precedence; an id for vocabularies that have none of them.
END_TOKENS, NO_END = ("<|eos|>", "</s>", "<|endoftext|>"), 2
#: Characters that are encoded at a time: an encoding is many times as large as its text.
STEP_CHARS = 1 << 18


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def end_id(path: str) -> int:
    t = _tokenizer(path)
    return next((i for i in map(t.token_to_id, END_TOKENS) if i is not None), NO_END)


def _steps(texts: list[str]) -> Iterator[list[str]]:
    """Stretches of texts that hold ``STEP_CHARS`` characters, or one text of more."""
    a, held = 0, 0
    for b, x in enumerate(texts):
        if b > a and held + len(x) > STEP_CHARS:
            yield texts[a:b]
            a, held = b, 0
        held += len(x)
    if texts:
        yield texts[a:]


def encoded(text: Column, path: str, *, end: bool = True) -> Column:
    """A text's ids and the end token; a text without ids, a null one too, gets none."""
    last = [end_id(path)] if end else []

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already, and each thread would hold memory of its own
        t = _tokenizer(path)
        for s in parts:
            out = []
            for step in _steps(s.fillna("").tolist()):
                # whole batches are held as four bytes an id, only a step's encodings as objects
                out += [np.array(e.ids + last if e.ids else [], np.int32) for e in t.encode_batch(step, add_special_tokens=False)]
            yield pd.Series(out, index=s.index)

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "array<int>")(text)


def texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text is neither null nor empty."""
    return docs.where(F.coalesce(F.col(text), F.lit("")) != "")
