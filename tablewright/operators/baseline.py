"""A drift baseline that stays where it lies: batches are tested against it, and only the batches' values move.

The baseline's distinct values are stored in order, in buckets, with the rows up to each value. At a bucket's last value
the share of the baseline is known without reading the bucket, and inside it the share lies between two known ones. So
most buckets can't hold the largest gap between the two distributions, and only the others are read, where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright import scratch
from tablewright.operators import drift
from tablewright.operators.prefix import BROADCAST_BUCKETS, ROWS_PER_BUCKET, range_parts, running_counts

# Distinct values in one bucket of a stored baseline.
BASELINE_BUCKET = 65_536
# Of a batch, at most so many distinct values are sent to the tasks that read the baseline.
SENT_VALUES = 500_000


@dataclass(frozen=True)
class StoredBaseline:
    """A baseline reduced to counts per distinct value, so that testing a batch does not read it again.

    ``numbers`` (feature, value, base, bucket, base_upto) is ordered; ``bounds`` has a row per feature and bucket: its last
    value, its rows, those below it, and all; ``categories`` has the rows of each category.
    """

    numbers: DataFrame
    bounds: DataFrame
    n_bounds: int
    categories: DataFrame
    numeric: Sequence[str]
    categorical: Sequence[str]

    @staticmethod
    def build(baseline: DataFrame, numeric: Sequence[str], categorical: Sequence[str], rows_per_bucket: int = BASELINE_BUCKET) -> StoredBaseline:
        numeric = [f for f in numeric if f in baseline.columns]
        categorical = [f for f in categorical if f in baseline.columns]
        counted = drift.base_values(baseline, numeric).groupBy("feature", "value").agg(F.sum("base").alias("base"))
        counted = scratch.write_table(counted, "baseline-counts")
        buckets = max(1, -(-counted.count() // rows_per_bucket))
        numbers = scratch.write_table(range_parts(counted, ["base"], buckets), "baseline-numbers")
        in_order, of_feature = Window.partitionBy("feature").orderBy("bucket"), Window.partitionBy("feature")
        below = F.sum("base").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
        bounds = numbers.groupBy("feature", "bucket").agg(F.max("value").alias("last"), F.sum("base").alias("base")).withColumns(
            {
                "base_below": F.coalesce(below, F.lit(0)),
                "base_total": F.sum("base").over(of_feature),
                "place": (F.row_number().over(in_order) - 1).cast("long"),
            }
        )
        categories = drift.base_categories(baseline, categorical).groupBy("feature", "category")
        bounds = scratch.write_table(bounds, "baseline-bounds")
        return StoredBaseline(
            numbers,
            bounds,
            bounds.count(),
            scratch.write_table(categories.agg(F.sum("new").alias("new"), F.sum("base").alias("base")), "baseline-categories"),
            numeric,
            categorical,
        )

    def report(
        self,
        new: DataFrame,
        alpha: float = drift.ALPHA,
        method: str = "corrected",
        rows_per_bucket: int = ROWS_PER_BUCKET,
        sent_values: int = SENT_VALUES,
    ) -> DataFrame:
        """The drift report of a table against this baseline."""
        numeric = [f for f in self.numeric if f in new.columns]
        categorical = [f for f in self.categorical if f in new.columns]
        parts = []
        if numeric:
            parts.append(drift.ks_rows(self.ks(new, numeric, alpha, method, rows_per_bucket, sent_values)))
        if categorical:
            base = self.categories.where(F.col("feature").isin(categorical))
            counts = drift.side_sums(drift.new_categories(new, categorical).unionByName(base))
            parts.append(drift.chi2_rows(drift.chi2_from_counts(counts, alpha)))
        return drift.one_report(parts)

    def ks(
        self,
        new: DataFrame,
        features: Sequence[str],
        alpha: float = drift.ALPHA,
        method: str = "corrected",
        rows_per_bucket: int = ROWS_PER_BUCKET,
        sent_values: int = SENT_VALUES,
    ) -> DataFrame:
        """The result of ``ks_drift`` against this baseline.

        The largest gap lies at a value of the batch or right below one, as between two of them only the baseline's share
        changes, in one direction. What moves are the batch's distinct values and one row per bucket.
        """
        drift.check_method(method)
        bounds = self.bounds.where(F.col("feature").isin(list(features)))
        batch = drift.new_values(new, features).select("feature", "value", "new", F.lit(0).cast("long").alias("edge"), "base")
        edges = bounds.select("feature", F.col("last").alias("value"), F.lit(0).cast("long").alias("new"), F.lit(1).cast("long").alias("edge"), "base")
        # Each bucket's rows stand at its last value: the shares there are exact, those in between are too low.
        placed = scratch.write_table(running_counts(batch.unionByName(edges), ["new", "edge", "base"], rows_per_bucket), "batch-places")
        bucket = bounds.select("feature", F.col("place").alias("edge_upto"), "bucket", F.col("base").alias("inside"))
        is_new = F.col("new") > 0
        ranged = placed.join(self._small(bucket), ["feature", "edge_upto"], "left").withColumn("inside", F.when(F.col("edge") > 0, 0).otherwise(F.coalesce("inside", F.lit(0))))
        both = (F.col("new_total") > 0) & (F.col("base_total") > 0)

        def gap(new_rows, base_rows):
            return F.abs(new_rows / F.col("new_total") - base_rows / F.col("base_total"))

        below, at, high = F.col("new_upto") - F.col("new"), F.col("new_upto"), F.col("base_upto") + F.col("inside")
        most = F.when(both & is_new, F.greatest(*[gap(n, b) for n in (below, at) for b in (F.col("base_upto"), high)]))
        known = F.when(both & (F.col("inside") == 0), gap(at, F.col("base_upto")))
        # A batch's value at a bucket's end has the baseline's share right below it inside the bucket.
        ends = F.when(both & is_new & (F.col("edge") > 0), gap(below, F.col("base_upto") - F.col("base")))
        rows = ranged.withColumns({"most": F.greatest(most, ends), "known": known})
        rows = rows.withColumn("place", F.col("edge_upto") - F.col("edge"))
        # One row per feature and bucket.
        by_bucket = rows.groupBy("feature", "place").agg(
            F.max("most").alias("most"), F.max("known").alias("known"), F.sum(is_new.cast("long")).alias("n_values"),
            F.max("new_total").alias("n_new"), F.max("base_total").alias("n_base"),
        )
        measured = by_bucket.groupBy("feature").agg(F.max("known").alias("known"), F.max("n_new").alias("n_new"), F.max("n_base").alias("n_base"))
        chosen = by_bucket.join(F.broadcast(measured.select("feature", F.col("known").alias("least"))), "feature")
        chosen = chosen.where(F.col("most") > F.coalesce("least", F.lit(-1.0))).join(bounds.select("feature", "place", "bucket", "base_below"), ["feature", "place"])
        chosen = chosen.select("feature", "place", "bucket", "base_below", "n_values")
        if self.n_bounds <= BROADCAST_BUCKETS:
            chosen = new.sparkSession.createDataFrame(chosen.collect(), chosen.schema)
        else:
            chosen = scratch.write_table(chosen, "chosen-buckets")
        exact = self._exact(rows.where(is_new).drop("bucket", "inside"), chosen, sent_values)
        inside = exact.groupBy("feature").agg(F.max(F.when(both, F.greatest(gap(at, F.col("le")), gap(below, F.col("lt"))))).alias("inside"))
        result = measured.join(inside, "feature", "left").select("feature", F.greatest("known", "inside").alias("statistic"), "n_new", "n_base")
        return drift.ks_verdicts(result, features, alpha, method)

    def _small(self, bounds: DataFrame) -> DataFrame:
        """Rows of bounds for a join: broadcast while the baseline has few buckets."""
        return F.broadcast(bounds) if self.n_bounds <= BROADCAST_BUCKETS else bounds

    def _exact(self, batch: DataFrame, chosen: DataFrame, sent_values: int) -> DataFrame:
        """The batch's values in the chosen buckets, with the baseline's rows up to them (``le``) and below them (``lt``)."""
        wanted = batch.join(self._small(chosen.drop("n_values")), ["feature", "place"])
        total = chosen.agg(F.sum("n_values"), F.collect_set("bucket")).first()
        baseline = self.numbers.join(self._small(chosen.select("feature", "bucket")), ["feature", "bucket"], "left_semi")
        # The list prunes what is read of the ordered files.
        baseline = baseline.where(F.col("bucket").isin(total[1]) if len(total[1]) <= 1000 else F.lit(True))
        if (total[0] or 0) <= sent_values:
            # The size was counted: at most ``sent_values`` values go to the tasks, the baseline's rows don't move.
            values = wanted.select("feature", "value", "bucket").toArrow()
            lookup = _sorted_values(values)
            found = baseline.select("feature", "bucket", "value", "base_upto").mapInArrow(lambda b: _shares(b, lookup), "feature string, value double, le long, lt long")
        else:
            # A batch of that size: its values and the chosen buckets meet in order.
            long = wanted.select("feature", "bucket", "value", F.lit(None).cast("long").alias("base"), F.lit(None).cast("long").alias("base_upto"))
            order = Window.partitionBy("feature", "bucket").orderBy("value")
            met = long.unionByName(baseline.select(*long.columns))
            le = F.max("base_upto").over(order.rangeBetween(Window.unboundedPreceding, 0))
            met = met.withColumns({"le": le, "here": F.sum("base").over(order.rangeBetween(0, 0))})
            found = met.where("base IS NULL").select("feature", "value", "le", (F.col("le") - F.coalesce("here", F.lit(0))).alias("lt"))
        # Sums of a part start at 0, so a value below a bucket's first one has none of it.
        shares = found.groupBy("feature", "value").agg(F.max("le").alias("le"), F.max("lt").alias("lt"))
        joined = wanted.join(shares, ["feature", "value"], "left")
        return joined.withColumns({c: F.coalesce(c, F.lit(0)) + F.col("base_below") for c in ("le", "lt")})


def _sorted_values(table: pa.Table) -> dict[tuple[str, int], np.ndarray]:
    """Per feature and bucket the batch's values in order."""
    out: dict[tuple[str, int], list[float]] = {}
    for feature, value, bucket in zip(*(table[c].to_pylist() for c in ("feature", "value", "bucket"))):
        out.setdefault((feature, bucket), []).append(value)
    return {k: np.sort(np.array(v)) for k, v in out.items()}


def _shares(batches: Iterator[pa.RecordBatch], lookup: dict[tuple[str, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """For the batch's values: the most rows of the baseline up to them, and below them, among the rows of this task."""
    le = {k: np.full(len(v), -1, dtype=np.int64) for k, v in lookup.items()}
    lt = {k: np.full(len(v), -1, dtype=np.int64) for k, v in lookup.items()}
    for batch in batches:
        feature, bucket = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        value, upto = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        # Runs of one feature and bucket.
        names = batch.column(0).dictionary_encode().indices.to_numpy()
        first = np.flatnonzero((np.diff(names, prepend=-1) != 0) | (np.diff(bucket, prepend=-1) != 0))
        for a, b in zip(first, np.append(first[1:], batch.num_rows)):
            key = (feature[a], int(bucket[a]))
            if key not in lookup:
                continue
            order = np.argsort(value[a:b], kind="stable")
            own, run = value[a:b][order], upto[a:b][order]
            for out, side in ((le[key], "right"), (lt[key], "left")):
                at = np.searchsorted(own, lookup[key], side=side)
                np.maximum(out, np.where(at > 0, run[np.maximum(at, 1) - 1], -1), out=out)
    for key, values in lookup.items():
        some = np.flatnonzero(le[key] >= 0)
        if len(some):
            columns = [pa.array([key[0]] * len(some)), pa.array(values[some]), pa.array(le[key][some]), pa.array(np.maximum(lt[key][some], 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "value", "le", "lt"])
