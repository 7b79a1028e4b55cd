"""Filling missing values: one-shot fills, and a fitted fill model shared by training and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import scratch
from tablewright.functions.columns import missing

# Largest statistics table that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# What a row of the hash table takes besides its values.
ROW_BYTES = 48
# A group with more rows than this is hot: its rows don't meet in one task.
TARGET_ROWS = 1_000_000


def group_means(df: DataFrame, group: str, value: str, nan_as_missing: bool = False) -> DataFrame:
    """Mean of ``value`` and number of rows per group; nulls form a group of their own."""
    return df.groupBy(group).agg(
        F.avg(_known(value, nan_as_missing)).alias(f"mean_{value}"), F.count(F.lit(1)).alias("n_rows")
    )


def column_mode(df: DataFrame, column: str) -> DataFrame:
    """The most frequent non-null value with its count, at most one row; a tie takes the smallest.

    Counting per value keeps the work in a partially aggregated shuffle, where the ``mode``
    aggregate would hold every distinct value in one task.
    """
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
        .limit(1)
    )


def fill_mode(df: DataFrame, column: str, fit_on: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the mode; a column without any value stays null."""
    mode = column_mode(df if fit_on is None else fit_on, column).select(column).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mode))


def fill_mean(
    df: DataFrame, column: str, fit_on: DataFrame | None = None, nan_as_missing: bool = False
) -> DataFrame:
    """Fill null and NaN with the mean.

    By default a NaN takes part in the mean (which is then NaN), as the plain ``avg`` does;
    ``nan_as_missing`` leaves it out.
    """
    source = df if fit_on is None else fit_on
    mean = source.agg(F.avg(_known(column, nan_as_missing)).alias("m")).scalar()
    return df.withColumn(column, F.when(missing(column, True), mean).otherwise(F.col(column)))


def fill_group_mean(
    df: DataFrame,
    group: str,
    value: str,
    output: str | None = None,
    nan_as_missing: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Fill nulls with the mean of the row's group, in one shot.

    A null group never matches, and a group without any value has no mean: both stay null.
    The per-group table is computed once and joined according to its measured size.
    """
    stats = scratch.write_table(group_means(df, group, value, nan_as_missing), "group-means")
    joined = join_group_stats(df, stats, group, [f"mean_{value}"], "n_rows", broadcast_bytes, target_rows)
    filled = F.when(missing(value, nan_as_missing), F.col(f"mean_{value}")).otherwise(F.col(value))
    return joined.withColumn(output or value, filled).drop(f"mean_{value}")


def join_group_stats(
    df: DataFrame,
    stats: DataFrame,
    group: str,
    carried: Sequence[str],
    rows_column: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Left-join a stored per-group table onto its rows, whatever its size and however skewed the rows.

    A small table is broadcast after its size was measured. Beyond that limit the groups of more
    than ``target_rows`` rows are broadcast on their own, and rows of hot or null groups leave the
    shuffle key: every input partition gets a key of its own for them that matches nothing, so a
    task receives at most cold groups and what input partitions hold. The hot groups are at most
    the rows over ``target_rows``; should they still be larger than BROADCAST_BYTES, the smaller
    ones among them are shuffled.
    """
    stats = stats.where(F.col(group).isNotNull()).select(group, *carried, rows_column)
    # By powers of two of the group's size: at most 64 rows.
    own_bytes = F.octet_length(F.col(group).cast("string")) + 16 * (1 + len(carried)) + ROW_BYTES
    levels = stats.groupBy(F.floor(F.log2(F.greatest(rows_column, F.lit(1)))).alias("level")).agg(F.sum(own_bytes).alias("bytes"))
    by_level = {r["level"]: r["bytes"] for r in levels.collect()}
    if sum(by_level.values()) <= broadcast_bytes:
        return df.join(F.broadcast(stats.drop(rows_column)), group, "left")
    limit, total = target_rows, 0
    for level in sorted((n for n in by_level if 2 ** (n + 1) > target_rows), reverse=True):
        total += by_level[level]
        if total > BROADCAST_BYTES:
            limit = max(target_rows, 2 ** (level + 1) - 1)
            break

    hot_names = {c: f"_hot_{c}" for c in carried}
    is_hot = F.col(rows_column) > limit
    hot = stats.where(is_hot).select(
        group, *[F.col(c).alias(h) for c, h in hot_names.items()], F.lit(True).alias("_hot")
    )
    # Always 0, but read from a column: Catalyst would fold a literal and drop the key from the shuffle.
    zero = F.pmod(F.col(rows_column), F.lit(1)).cast("int")
    cold = stats.where(~is_hot).withColumn("_spread", zero).drop(rows_column).hint("merge")
    # The salt is the number of the input partition: the same on every retry of a task.
    salt = F.when(F.col("_hot").isNotNull() | F.col(group).isNull(), F.spark_partition_id() + 1).otherwise(F.lit(0))
    joined = df.join(F.broadcast(hot), group, "left").withColumn("_spread", salt).join(cold, [group, "_spread"], "left")
    return joined.withColumns({c: F.coalesce(h, c) for c, h in hot_names.items()}).drop(
        "_spread", "_hot", *hot_names.values()
    )


@dataclass(frozen=True)
class FillSpec:
    """What to fill: group means as ``output -> (group, value)``, and columns by mean or by mode."""

    group_mean: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    mean: Sequence[str] = ()
    mode: Sequence[str] = ()
    nan_as_missing: bool = False
    global_fallback: bool = False


@dataclass(frozen=True)
class FillModel:
    """Fitted fills. Both tables are stored, so training and scoring use the same values."""

    spec: FillSpec
    groups: DataFrame  # (fill, group_value, mean, n_rows)
    constants: DataFrame  # (column, kind, number, text), one row per filled column

    @staticmethod
    def fit(df: DataFrame, spec: FillSpec) -> FillModel:
        """Compute every fill in one pass over the needed columns.

        Grouping sets give the groups of each group mean, the values of each mode column and the
        grand total together; the modes and means are then read off the small result.
        """
        keys = list(dict.fromkeys([g for g, _ in spec.group_mean.values()] + list(spec.mode)))
        sets = [[c] for c in keys] + [[]]
        values = list(dict.fromkeys([v for _, v in spec.group_mean.values()] + list(spec.mean)))
        # Keys are copied under other names, so that a column may be both key and value.
        narrowed = df.select(
            *[F.col(c).alias(f"k_{c}") for c in keys], *[_known(c, spec.nan_as_missing).alias(f"v_{c}") for c in values]
        )
        by_set = (
            narrowed.groupingSets([[f"k_{c}" for c in s] for s in sets], *[f"k_{c}" for c in keys])
            if keys
            else narrowed.groupBy()
        )
        grouped = by_set.agg(
            *[F.grouping(f"k_{c}").alias(f"g_{c}") for c in keys],
            *[F.avg(f"v_{c}").alias(f"mean_{c}") for c in values],
            F.count(F.lit(1)).alias("n_rows"),
        )
        stats = scratch.write_table(grouped, "fills")
        return FillModel(spec, _group_rows(stats, spec, keys), _constant_rows(stats, spec, keys))

    def apply(self, df: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """Fill ``df``; lazily, and as well on a stream."""
        constants = {
            (r["column"], r["kind"]): r["text"] if r["kind"] == "mode" else r["number"]
            for r in self.constants.collect()  # one row per filled column
        }
        out = df
        for output, (group, value) in self.spec.group_mean.items():
            stats = self.groups.where(F.col("fill") == output).select(
                F.col("group_value").cast(df.schema[group].dataType).alias(group),
                F.col("mean").alias(f"_mean_{output}"),
                "n_rows",
            )
            fallback = F.lit(constants.get((value, "mean"))) if self.spec.global_fallback else F.lit(None)
            own = F.when(missing(value, self.spec.nan_as_missing), F.lit(None)).otherwise(F.col(value))
            out = (
                join_group_stats(out, stats, group, [f"_mean_{output}"], "n_rows", broadcast_bytes)
                .withColumn(output, F.coalesce(own, F.col(f"_mean_{output}"), fallback.cast("double")))
                .drop(f"_mean_{output}")
            )
        for column in self.spec.mode:
            mode = F.lit(constants.get((column, "mode"))).cast(df.schema[column].dataType)
            out = out.withColumn(column, F.coalesce(F.col(column), mode))
        for column in self.spec.mean:
            mean = F.lit(constants.get((column, "mean"))).cast("double")
            out = out.withColumn(column, F.when(missing(column, True), mean).otherwise(F.col(column)))
        return out

    def save(self, path: str) -> None:
        self.groups.write.mode("overwrite").parquet(f"{path}/groups")
        self.constants.write.mode("overwrite").parquet(f"{path}/constants")

    @staticmethod
    def load(spark: SparkSession, path: str, spec: FillSpec) -> FillModel:
        return FillModel(spec, spark.read.parquet(f"{path}/groups"), spark.read.parquet(f"{path}/constants"))


def _known(column: str, nan_as_missing: bool) -> Column:
    c = F.col(column)
    return F.when(~F.isnan(c), c) if nan_as_missing else c


def _of_set(keys: Sequence[str], kept: str | None) -> Column:
    """Rows of the grouping set that keeps the key ``kept`` (or none, for the grand total)."""
    condition = F.lit(True)
    for c in keys:
        condition = condition & (F.col(f"g_{c}") == (0 if c == kept else 1))
    return condition


def _group_rows(stats: DataFrame, spec: FillSpec, keys: Sequence[str]) -> DataFrame:
    parts = [
        stats.where(_of_set(keys, group) & F.col(f"k_{group}").isNotNull()).select(
            F.lit(output).alias("fill"),
            F.col(f"k_{group}").cast("string").alias("group_value"),
            F.col(f"mean_{value}").alias("mean"),
            "n_rows",
        )
        for output, (group, value) in spec.group_mean.items()
    ]
    return _stacked(parts, stats.sparkSession, "fill string, group_value string, mean double, n_rows bigint")


def _constant_rows(stats: DataFrame, spec: FillSpec, keys: Sequence[str]) -> DataFrame:
    modes = [
        stats.where(_of_set(keys, c) & F.col(f"k_{c}").isNotNull())
        .orderBy(F.desc("n_rows"), F.asc(f"k_{c}"))
        .limit(1)
        .select(
            F.lit(c).alias("column"),
            F.lit("mode").alias("kind"),
            F.lit(None).cast("double").alias("number"),
            F.col(f"k_{c}").cast("string").alias("text"),
        )
        for c in spec.mode
    ]
    meaned = list(dict.fromkeys(list(spec.mean) + [v for _, v in spec.group_mean.values()]))
    means = [
        stats.where(_of_set(keys, None)).select(
            F.lit(c).alias("column"),
            F.lit("mean").alias("kind"),
            F.col(f"mean_{c}").cast("double").alias("number"),
            F.lit(None).cast("string").alias("text"),
        )
        for c in meaned
    ]
    return _stacked(modes + means, stats.sparkSession, "column string, kind string, number double, text string")


def _stacked(parts: Sequence[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
