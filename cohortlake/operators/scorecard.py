"""Weight of evidence and information value, dummies, coarse classes and splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions import columns as fx

# -- weight of evidence -------------------------------------------------------------


def woe_tables(df: DataFrame, variables: Sequence[str], target: str, smoothing: float = 0.0) -> DataFrame:
    """WoE and IV of many discrete variables at once; ``target`` is 1 for good.

    Rows unpivot to (variable, category) and are counted with map-side aggregation, so a category
    that holds a third of the data is one small partial row per task. Everything after that works
    on one row per category. NULL categories and NULL targets are left out. An empty class gives
    NULL unless ``smoothing`` is added to both classes.
    """
    pairs = df.filter(F.col(target).isNotNull()).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(v).alias("variable"), F.col(v).cast("string").alias("category"))
                    for v in variables
                ]
            )
        ),
        F.col(target).cast("double").alias("good"),
    )
    counts = (
        pairs.filter(F.col("category").isNotNull())
        .groupBy("variable", "category")
        .agg(F.count(F.lit(1)).alias("n_obs"), F.avg("good").alias("prop_good"))
    )
    return woe_from_counts(counts, smoothing)


def woe_from_counts(counts: DataFrame, smoothing: float = 0.0) -> DataFrame:
    """WoE table from ``(variable, category, n_obs, prop_good)``."""
    of_variable = Window.partitionBy("variable")
    by_woe = of_variable.orderBy(F.col("woe").asc_nulls_last(), "category")

    def share(c: str) -> Column:
        return fx.safe_ratio(F.col(c), F.sum(c).over(of_variable))

    good, bad = F.col("prop_n_good"), F.col("prop_n_bad")
    table = (
        counts.withColumns(
            {
                "n_good": F.col("prop_good") * F.col("n_obs"),
                "n_bad": (1 - F.col("prop_good")) * F.col("n_obs"),
            }
        )
        .withColumns({"_good": F.col("n_good") + smoothing, "_bad": F.col("n_bad") + smoothing})
        .withColumns({"prop_n_obs": share("n_obs"), "prop_n_good": share("_good"), "prop_n_bad": share("_bad")})
        .withColumn("woe", F.when((good > 0) & (bad > 0), F.log(good / bad)))
        .withColumns(
            {
                "rank": F.row_number().over(by_woe),
                "diff_prop_good": F.abs(F.col("prop_good") - F.lag("prop_good").over(by_woe)),
                "diff_woe": F.abs(F.col("woe") - F.lag("woe").over(by_woe)),
                "iv": F.sum((good - bad) * F.col("woe")).over(of_variable),
            }
        )
    )
    return table.select(
        "variable",
        "category",
        "rank",
        "n_obs",
        "prop_good",
        "prop_n_obs",
        "n_good",
        "n_bad",
        "prop_n_good",
        "prop_n_bad",
        "woe",
        "diff_prop_good",
        "diff_woe",
        "iv",
    )


def woe_discrete(df: DataFrame, variable: str, target: str, smoothing: float = 0.0) -> DataFrame:
    """One variable's table, with the category under the variable's own name."""
    table = woe_tables(df, [variable], target, smoothing)
    return table.drop("variable").withColumnRenamed("category", variable)


# -- dummies and coarse classes --------------------------------------------------------


def categories(df: DataFrame, columns: Sequence[str], max_categories: int = 10_000) -> dict[str, list[str]]:
    """Observed non-NULL values per column, sorted, found in one job.

    They become column names, hence the checked bound: more values raise, none are dropped.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    found = df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()
    rows = found.limit(max_categories + 1).collect()
    if len(rows) > max_categories:
        raise ValueError(f"more than {max_categories} values in {', '.join(columns)}; bin them before making dummies")
    return {c: sorted(r["value"] for r in rows if r["column"] == c) for c in columns}


def one_hot(
    df: DataFrame, columns: Sequence[str], separator: str = ":", known: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Add a 0/1 column ``column:value`` per value; a NULL gets 0 everywhere."""
    values = dict(known or {})
    unknown = [c for c in columns if c not in values]
    if unknown:
        values |= categories(df, unknown)
    dummies = {
        f"{c}{separator}{v}": F.when(F.col(c).cast("string") == v, 1).otherwise(0) for c in columns for v in values[c]
    }
    return df.withColumns(dummies)


def merge_dummies(df: DataFrame, column: str, values: Sequence[str], separator: str = ":") -> DataFrame:
    """Sum the dummies of several values into one coarse class named after all of them."""
    total = F.lit(0)
    for value in values:
        name = f"{column}{separator}{value}"
        if name in df.columns:
            total = total + F.col(f"`{name}`")
    return df.withColumn(f"{column}{separator}{'_'.join(values)}", total)


def coarse_class(column: str, classes: Mapping[str, Sequence[str]]) -> Column:
    """Merged category label; values outside every class keep their own."""
    c = F.col(column)
    expr = c
    for name, members in classes.items():
        expr = F.when(c.isin(*members), F.lit(name)).otherwise(expr)
    return expr


# -- splits ------------------------------------------------------------------------------


def hash_split(
    df: DataFrame, key: str, test_percent: int = 20, seed: int = 42, name: str = "split"
) -> DataFrame:
    """'train' / 'test' by a hash of the key: stable under re-runs, retries and new rows."""
    in_test = fx.hash_bucket(key, seed, 100) < test_percent
    return df.withColumn(name, F.when(in_test, "test").otherwise("train"))


def modulus_split(df: DataFrame, key: str, test_percent: int = 20, name: str = "split") -> DataFrame:
    in_test = F.pmod(F.col(key), F.lit(100)) < test_percent
    return df.withColumn(name, F.when(in_test, "test").otherwise("train"))
