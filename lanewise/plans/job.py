"""The whole job with its inputs and outputs on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanewise.config import PipelineConfig
from lanewise.plans.runs import Run
from lanewise.plans.shipments import PACKAGE_KEYS, enrich, features, model_sets
from lanewise.plans.training import Trained, train_and_report
from lanewise.sources import TABLES, read, read_table, write
from lanewise.sources.schemas import lost_values

#: The enriched table is laid out by delivery date, which the sets are cut by; the second column splits a busy day.
LAYOUT = ["SHIPMENT_DELIVERY_DATE", "SHIPMENT_TRACKING_NUMBER"]


def load_tables(spark: SparkSession, locations: dict[str, str | tuple[str, str]]) -> dict[str, DataFrame]:
    """The input tables, checked against their schemas.

    Each location is the name of a catalog table, or a (path, format) pair.
    """
    missing = [name for name in TABLES if name not in locations]
    if missing:
        raise ValueError(f"no location for: {', '.join(missing)}")
    return {
        name: read_table(spark, locations[name], schema)
        if isinstance(locations[name], str)
        else read(spark, *locations[name], schema)
        for name, schema in TABLES.items()
    }


def input_losses(spark: SparkSession, locations: dict[str, str | tuple[str, str]]) -> dict[str, DataFrame]:
    """Per table, one row with the number of values of each column that do not parse and count as missing."""
    raw = {name: read_table(spark, at) if isinstance(at, str) else read(spark, *at) for name, at in locations.items()}
    return {name: lost_values(df, TABLES[name]) for name, df in raw.items()}


def prepare(tables: dict[str, DataFrame], cfg: PipelineConfig) -> dict[str, str]:
    """Write the reporting table, the enriched table and the train and test sets; return their paths by name.

    A package is told by all its own columns, since an order and tracking number may stand for several. One with several
    rows ends the job, unless `cfg.allow_fan_out`. Each table is a step of a `Run`: after a failure, or when the driver was
    lost, a call with the same settings goes on after the last table that was written whole, and `runs.manifest` tells rows,
    packages and seconds of each. A finished run does nothing; give another `run_tag` for other input.
    """
    run, unique = Run(next(iter(tables.values())).sparkSession, cfg), not cfg.allow_fan_out
    count = {"keys": PACKAGE_KEYS, "unique": unique}
    reporting = run.step("reporting", cfg.reporting_path, lambda: enrich(tables, cfg), partitions=cfg.output_files, **count)
    enriched = run.step("enriched", cfg.enriched_path, lambda: features(reporting, tables, cfg), partitions=cfg.output_files, range_by=LAYOUT, **count)
    paths = {name: cfg.set_path(name) for name in cfg.date_ranges}
    for name, path in paths.items():
        run.step(f"set-{name}", path, lambda name=name: model_sets(enriched, cfg)[name])
    return paths


def train(spark: SparkSession, cfg: PipelineConfig) -> Trained:
    """Train on the written sets and write the prediction report as CSV."""
    train_set = read(spark, cfg.set_path("train_val"))
    test_set = read(spark, cfg.set_path("test"))
    trained = train_and_report(train_set, test_set, cfg)
    write(trained.report, cfg.prediction_path, format="csv")
    return trained
