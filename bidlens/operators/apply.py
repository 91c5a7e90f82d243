"""User functions over independent items."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def parallel_apply(items: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                   spread_over: int | None = None) -> DataFrame:
    """Run ``fn`` on Arrow batches of items on all executors; results come unordered.

    For functions without a column expression. Items are independent, so no grouping
    takes place; ``spread_over`` re-deals costly items over that many tasks.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    dealt = items.repartition(spread_over) if spread_over else items
    return dealt.mapInPandas(run, schema)
