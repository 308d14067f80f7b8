"""Token counts behind plain callables: text in, number of tokens out."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StringType

Counter = Callable[[str], int]
_PIECES = re.compile(r"\w+|[^\w\s]")


def count_pieces(text: str) -> int:
    """Words and marks: needs no model, and agrees with none."""
    return len(_PIECES.findall(text))


def from_file(path: str) -> Counter:
    """A tokenizer's counter from its file (.json or .model), loaded once in a worker."""
    held: list = []

    def count(text: str) -> int:
        if not held:
            if path.endswith(".model"):
                import sentencepiece

                model = sentencepiece.SentencePieceProcessor(model_file=path)
                held.append(lambda t: len(model.encode(t)))
            else:
                import tokenizers

                model = tokenizers.Tokenizer.from_file(path)
                held.append(lambda t: len(model.encode(t, add_special_tokens=False).ids))
        return held[0](text)

    return count


def token_counts(c: Column, counters: dict[str, Counter] | None = None) -> Column:
    """map of model name to tokens; null texts count as empty."""
    named = counters or {"pieces": count_pieces}

    @F.pandas_udf(MapType(StringType(), IntegerType()))
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: {n: int(f(t or "")) for n, f in named.items()})

    return count(F.coalesce(c, F.lit("")))
