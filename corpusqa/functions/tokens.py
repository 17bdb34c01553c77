"""Token counts: a native estimate, or a counter the caller supplies."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusqa.functions.text import col

# A token is a run of letters, up to three digits, or a run of other
# non-blank characters.
TOKEN_PATTERN = r"\p{L}++|\p{N}{1,3}+|[^\s\p{L}\p{N}]++"

TokenCounter = Callable[[Column], Column]


def estimate_tokens(text: Column | str) -> Column:
    """Estimated token count, without Python. An estimate, not a BPE count."""
    found = F.regexp_extract_all(col(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.size(found).cast("bigint")


def counter_from(count: Callable[[str], int]) -> TokenCounter:
    """Turn a Python ``str -> int`` counter into a column function (Arrow batches)."""

    @F.pandas_udf("bigint")
    def counted(texts: pd.Series) -> pd.Series:
        return texts.map(count, na_action="ignore").astype("Int64")

    return lambda text: counted(col(text))


def bpe_counter(model: str = "gpt-4o-mini") -> TokenCounter:
    """Exact BPE counts through ``tiktoken``, where its tables can be loaded."""
    import tiktoken

    tiktoken.encoding_for_model(model)  # fail here, not in a task

    def count(text: str) -> int:
        return len(tiktoken.encoding_for_model(model).encode(text))

    return counter_from(count)
