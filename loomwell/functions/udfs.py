"""Python functions on columns, for what built-ins cannot say.

Each has a built-in twin elsewhere in the package; the twin is the one to use on
large data because it stays inside generated code.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwell.functions.numbers import TIER_BOUNDS
from loomwell.operators.windows import with_group_stats

# Send these functions themselves to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def capitalised(words: list[str]) -> str:
    """Words that blanks, ``_`` or ``-`` separated, each with a capital first letter only."""
    return " ".join(w[:1].upper() + w[1:].lower() for w in words)


def tidy_name(name: str | None) -> str | None:
    return None if name is None else capitalised(re.split("[ _-]", name.strip(" ")))


def tidy_series(names: pd.Series) -> pd.Series:
    return names.str.strip(" ").str.split("[ _-]", regex=True).map(capitalised, na_action="ignore")


# Rows travel in Arrow batches even for the row-wise form.
normalise_name_udf = F.udf(tidy_name, T.StringType(), useArrow=True)


@F.pandas_udf(T.StringType())
def normalise_name_pandas(names: pd.Series) -> pd.Series:
    return tidy_series(names)


@F.pandas_udf(T.StringType())
def price_tier_pandas(prices: pd.Series) -> pd.Series:
    bounds = [float("inf") if b is None else b for b in TIER_BOUNDS.values()]
    tiers = pd.cut(prices, bins=[0, *bounds], labels=list(TIER_BOUNDS), right=True)
    return tiers.astype(object).where(tiers.notna(), None)


@F.pandas_udf(T.StringType())
def normalise_name_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Iterator form: set-up before the loop runs once per task, not once per batch."""
    separator = re.compile("[ _-]")
    for names in batches:
        yield names.map(lambda n: capitalised(separator.split(n.strip(" "))), na_action="ignore")


def line_totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas step: price after discount per line, in whole cents."""
    for pdf in batches:
        cents = (pdf["price_cents"] * (100 - pdf["discount_pct"])) // 100
        yield pd.DataFrame({"l_orderkey": pdf["l_orderkey"], "l_linenumber": pdf["l_linenumber"], "net_cents": cents})


def group_zscore(
    df: DataFrame, keys: list[str], row_id: str, value: str, name: str, chunk_rows: int, digits: int = 3
) -> DataFrame:
    """Grouped-map z-score: NULL where the sample deviation is 0 or undefined.

    Group mean and deviation come from a built-in aggregate; the grouped map then
    runs on chunks of about ``chunk_rows`` rows, so a group of any size never has
    to fit into one pandas frame.
    """
    stats = {"_mean": F.avg(value), "_sd": F.stddev_samp(value), "_n": F.count(F.lit(1))}
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
    columns = df.columns

    def zscore(pdf: pd.DataFrame) -> pd.DataFrame:
        sd = pdf["_sd"].where(pdf["_sd"] > 0)
        pdf[name] = ((pdf[value] - pdf["_mean"]) / sd).round(digits)
        return pdf[[*columns, name]]

    chunks = F.ceil(F.col("_n") / chunk_rows)
    return (
        with_group_stats(df, keys, stats)
        .withColumn("_chunk", F.pmod(F.xxhash64(row_id), chunks))
        .groupBy(*keys, "_chunk")
        .applyInPandas(zscore, schema)
    )
