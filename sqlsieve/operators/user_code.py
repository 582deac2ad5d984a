"""The caller's own Python over batches of rows.

Pandas leaves accessors, such as the one behind ``.str``, on the objects that they refer to. Batches in
such circles would stay in a worker until a full collection, which is rare, so the caller's code gets a
view of each batch and the views are collected before the next one.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


def keep_if(test: Callable[..., pd.Series], *columns: str) -> Column:
    """Condition that calls ``test`` with the named columns, a batch of rows at a time.

    For rules that Column expressions cannot state; only the named columns go to Python, and
    ``test`` gets each as a Series and returns one of truth values.
    """

    @F.pandas_udf(BooleanType())
    def run(*series: pd.Series) -> pd.Series:
        kept = pd.Series(test(*[s.copy(deep=False) for s in series])).astype(bool)
        gc.collect(1)
        return kept

    return run(*columns)


def map_batches(
    df: DataFrame, change: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Rows of ``df`` replaced batch by batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            changed = change(batch.copy(deep=False))
            gc.collect(1)
            yield changed

    return df.mapInPandas(run, schema)
