"""Rows in, rows rejected, groups and rows out, counted while the job runs.

The reference prints a line per record and per group; here the counts are
accumulated by ``DataFrame.observe`` on the executors and read once, after
the action, from an ``Observation``; ``StageCounts`` gathers the observations
of a job and returns them as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach named aggregate metrics to ``df``; read them with ``obs.get`` after an action."""
    obs = Observation(name)
    exprs = [expr.alias(key) for key, expr in metrics.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *exprs), obs


def count_accepted(df: DataFrame, name: str, accepted: Column) -> tuple[DataFrame, Observation]:
    """Count rows in and rows rejected by the condition ``accepted`` (null counts as rejected)."""
    return observed(
        df, name,
        rows_in=F.count(F.lit(1)),
        rows_rejected=F.count_if(~F.coalesce(accepted, F.lit(False))),
    )


class StageCounts:
    """The counts of a job's stages, in the order they were attached; rows of a DataFrame once the job has run.

        counts = StageCounts()
        lines = counts.watch(lines, "lines", rows=F.count(F.lit(1)))
        kept = counts.accept(lines, "arity", F.size("f") == 5)
        kept.write.parquet(...)            # any action over all rows
        counts.rows(spark)                 # stage, metric, value

    A stage is counted by the first action that runs it whole; reading waits
    for that action. Counts are 64-bit.
    """

    def __init__(self) -> None:
        self._stages: list[tuple[str, Observation]] = []

    def add(self, stage: str, observation: Observation) -> None:
        """Count a stage by an observation attached elsewhere."""
        if stage in dict(self._stages):
            raise ValueError(f"stage {stage!r} is counted already")
        self._stages.append((stage, observation))

    def watch(self, df: DataFrame, stage: str, **metrics: Column) -> DataFrame:
        """``df`` with named aggregate metrics (none: ``rows``)."""
        out, obs = observed(df, stage, **metrics)
        self.add(stage, obs)
        return out

    def accept(self, df: DataFrame, stage: str, accepted: Column) -> DataFrame:
        """``df``, all rows, with ``rows_in`` and ``rows_rejected`` by a condition."""
        out, obs = count_accepted(df, stage, accepted)
        self.add(stage, obs)
        return out

    def run(self, df: DataFrame) -> StageCounts:
        """Run ``df`` for its counts alone; its rows are computed where they are and go nowhere."""
        df.write.format("noop").mode("overwrite").save()
        return self

    def values(self) -> dict[str, dict[str, int]]:
        """Stage -> metric -> value."""
        return {stage: dict(obs.get) for stage, obs in self._stages}

    def rows(self, spark: SparkSession) -> DataFrame:
        """``(stage, metric, value)``, one row for each metric of each stage."""
        found = [(stage, metric, value) for stage, own in self.values().items() for metric, value in own.items()]
        return spark.createDataFrame(found, "stage string, metric string, value long")

    def row(self, spark: SparkSession, stage: str) -> DataFrame:
        """One stage's metrics as the columns of one row."""
        own = self.values()[stage]
        return spark.createDataFrame([tuple(own.values())], ", ".join(f"`{k}` long" for k in own))
