"""A run's record on storage: which steps are finished, so that a run that broke off goes on after the last of them."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.config import PipelineConfig
from lanewise.operators.quality import profile
from lanewise.session import remove, scratch
from lanewise.sources import write

RECORD = "step string, path string, settings string, row_count long, key_count long, seconds double"


def settings_of(cfg: PipelineConfig) -> str:
    """A digest of all settings: steps made with others are not taken over."""
    return hashlib.sha256(repr(cfg).encode()).hexdigest()


class Run:
    """Steps of one run. A step is a table that is made, written to its path and then recorded under `manifest/`.

    The record is written when all of the table is there, so it tells whether a step is finished whatever happened to the
    driver. A step that was not finished is made anew and overwrites what it had begun. Staged tables of a step are removed
    when it is finished or has failed.
    """

    def __init__(self, spark: SparkSession, cfg: PipelineConfig):
        self.spark, self.cfg, self.settings = spark, cfg, settings_of(cfg)
        self.fresh = False  # whether a step was made in this attempt

    def _place(self, step: str) -> str:
        return f"{self.cfg.path('manifest')}/{step}"

    def finished(self, step: str) -> dict | None:
        """The record of a step made with these settings, if it is finished."""
        try:
            found = self.spark.read.schema(RECORD).json(self._place(step)).first()
        except AnalysisException:  # no such folder
            return None
        return found.asDict() if found is not None and found["settings"] == self.settings else None

    def step(self, name: str, path: str, make: Callable[[], DataFrame], keys: list[str] | None = None, unique: bool = False, **layout) -> DataFrame:
        """The table at `path`: as it was left by an attempt that finished this step, or made and written now.

        With `keys` their distinct values are counted and recorded beside the rows; `unique` ends the run if there are fewer.
        Once a step is made anew, so are all that follow, as `make` reads what the ones before wrote.
        """
        if self.fresh or self.finished(name) is None:
            self.fresh = True
            start = time.monotonic()
            remove(self.spark, self._place(name))
            with scratch(self.spark, f"{self.cfg.run_tag}-{self.settings[:12]}-{name}"):
                write(make(), path, **layout)
            made = self.spark.read.parquet(path)
            counts = profile(made.select(*keys), keys).first() if keys else made.agg(F.count("*").alias("row_count")).first()
            rows, distinct = counts["row_count"], counts["key_count"] if keys else None
            if unique and rows > distinct:
                raise ValueError(f"{name}: {rows} rows for {distinct} values of {keys[0]}, ...")
            record = [(name, path, self.settings, rows, distinct, round(time.monotonic() - start, 3))]
            self.spark.createDataFrame(record, RECORD).coalesce(1).write.mode("overwrite").json(self._place(name))
        return self.spark.read.parquet(path)


def manifest(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """(step, path, settings, row_count, key_count, seconds) of the steps that are finished; none is no row."""
    try:
        return spark.read.schema(RECORD).json(f"{cfg.path('manifest')}/*")
    except AnalysisException:
        return spark.createDataFrame([], RECORD)
