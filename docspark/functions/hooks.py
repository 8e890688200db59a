"""Places where a user's model plugs in, always as Arrow-batched pandas UDFs.

No provider ships with the package.  Filters go in front of a hook, because
Spark does not push a filter through Python; and a hook counts as
nondeterministic, so that a filter on its result does not run it twice.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TextHook = Callable[[pd.Series, str], pd.Series]


def text_hook(fn: TextHook, prompt: str = "") -> Callable[[Column], Column]:
    """``fn(texts, prompt) -> texts`` for table and figure summaries."""

    @F.pandas_udf("string")
    def call(texts: pd.Series) -> pd.Series:
        return fn(texts, prompt)

    return call.asNondeterministic()


def extractor(fn: Callable[[pd.Series, str], pd.DataFrame], schema: T.StructType, prompt: str = "") -> Callable[[Column], Column]:
    """``fn(texts, prompt) -> DataFrame`` whose columns follow the user's schema."""

    @F.pandas_udf(schema)
    def call(texts: pd.Series) -> pd.DataFrame:
        return fn(texts, prompt)

    return call.asNondeterministic()


def page_classifier(fn: Callable[[pd.Series], pd.DataFrame]) -> Callable[[Column], Column]:
    """``fn(texts) -> DataFrame(page_class, score, reason)`` in place of the term score."""

    @F.pandas_udf("page_class string, score double, reason string")
    def call(texts: pd.Series) -> pd.DataFrame:
        return fn(texts)

    return call.asNondeterministic()
