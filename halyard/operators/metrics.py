"""Regional metrics in one currency."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: US dollars for one unit of a country's currency.
USD = {"zanzibar": 0.00037, "kenya": 0.0077}
MONEY = ("mean_rpue", "mean_rpua", "mean_price_kg")


def unite(*frames: DataFrame) -> DataFrame:
    """All rows by column name, missing columns null; a column of two types is an error rather than a cast."""
    kinds: dict[str, str] = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            if "void" not in (kind, kinds.get(name, kind)) and kinds.setdefault(name, kind) != kind:
                raise TypeError(f"column {name!r} is {kinds[name]} and {kind}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def in_usd(metrics: DataFrame, rates: dict[str, float] = USD, columns: tuple[str, ...] = MONEY) -> DataFrame:
    """The money columns converted by country; a country without a rate makes them null."""
    rate = reduce(lambda when, x: when.when(F.col("country") == x[0], F.lit(x[1])), rates.items(), F)
    return metrics.withColumns({c: F.col(c) * rate for c in columns})
