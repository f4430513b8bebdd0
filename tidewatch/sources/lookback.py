"""What a scheduled run keeps of its rows for the next one, versioned by run id beside the state.

A trailing window of w rows needs the last w - 1 rows of its series, whatever run brought them.
Each run reads the newest version before it, scores its own rows behind those, and writes the
next version. Decompositions look at the whole series, so in the seasonal modes every row is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..options import DetectOptions
from .state import state_versions


def read_lookback(spark: SparkSession, base: str, before: str) -> DataFrame | None:
    """The newest committed version older than run ``before``, or None."""
    versions = [v for v in state_versions(spark, f"{base}/lookback") if v < before]
    return spark.read.parquet(f"{base}/lookback/run={versions[-1]}") if versions else None


def write_lookback(rows: DataFrame, base: str, run_id: str) -> None:
    rows.write.mode("overwrite").parquet(f"{base}/lookback/run={run_id}")


def next_lookback(long: DataFrame, history: DataFrame | None, options: DetectOptions,
                  keys: Sequence[str] = (), ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """The rows of this run and of its lookback that the next run has to see.

    The limit on ``row_number`` is applied in each task before the shuffle where Spark can plan it,
    and never keeps more than one row short of a window for each series.
    """
    rows = long if history is None else history.select(long.columns).unionByName(long)
    if options.mode != "zscore":
        return rows
    newest = Window.partitionBy(*keys, "metric").orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in tiebreak])
    return (rows.withColumn("_rank", F.row_number().over(newest))
            .filter(F.col("_rank") <= options.window_size - 1).drop("_rank"))


def split_late(long: DataFrame, history: DataFrame, keys: Sequence[str] = (), ts: str = "ts",
               tiebreak: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(rows behind the series' last kept row, late rows)``.

    A late row would change windows that earlier runs have decided on; it is left out of scoring
    and reported, so what has been decided stays.
    """
    sk = [*keys, "metric"]
    place = F.struct(ts, *tiebreak)
    last = history.groupBy(*sk).agg(F.max(place).alias("_last"))
    met = long.alias("new")
    for c in sk:                                # series with null keys are series too
        last = last.withColumnRenamed(c, f"_k_{c}")
    same = None
    for c in sk:
        one = F.col(f"new.{c}").eqNullSafe(F.col(f"_k_{c}"))
        same = one if same is None else same & one
    met = met.join(last, same, "left").select(*[F.col(f"new.{c}") for c in long.columns], "_last")
    late = F.col("_last").isNotNull() & (place <= F.col("_last"))
    return met.filter(~late).select(long.columns), met.filter(late).select(long.columns)
