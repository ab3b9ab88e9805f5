"""User functions over column batches and over training batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def map_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
    *,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Apply ``fn`` to Arrow batches of rows; what it returns is the new table.

    Only ``columns`` travel to Python. The size of a batch is set by
    spark.sql.execution.arrow.maxRecordsPerBatch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    source = df.select(*columns) if columns else df
    return source.mapInPandas(run, schema)


def collate_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
    *,
    batch: Sequence[str] = ("epoch", "batch_id"),
    pos: str = "pos",
    columns: Sequence[str] = (),
) -> DataFrame:
    """Apply ``fn`` once per training batch, its rows in ``pos`` order."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return fn(rows.sort_values(pos, ignore_index=True))

    return df.select(*batch, pos, *columns).groupBy(*batch).applyInPandas(run, schema)
