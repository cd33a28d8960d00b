"""A run that breaks off goes on after its last whole step, and leaves nothing behind that was only staged."""

import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lanewise.config import PipelineConfig
from lanewise.plans import job, runs
from lanewise.session import scratch, shared_dir, staging_path
from lanewise.sources import stage, stage_all
from shipment_checks import view
from tests.conftest import SF_DIR


def staged(spark):
    folder = f"{shared_dir(spark).removeprefix('file:')}/staged"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


@pytest.fixture
def cfg(tmp_path):
    return view.config(output_root=str(tmp_path), run_tag="night")


def test_a_broken_run_goes_on_after_its_last_whole_step(spark, cfg, monkeypatch):
    tables = view.tables(spark, SF_DIR)
    before, made = staged(spark), []

    def counted(name, broken=False):
        plain = getattr(job, name)

        def make(*args):
            made.append(name)
            if broken:
                stage(spark.range(5), name="begun")
                raise RuntimeError("the driver is lost")
            return plain(*args)

        return make

    with monkeypatch.context() as patch:
        patch.setattr(job, "enrich", counted("enrich"))
        patch.setattr(job, "features", counted("features", broken=True))
        with pytest.raises(RuntimeError, match="lost"):
            job.prepare(tables, cfg)
    assert made == ["enrich", "features"] and staged(spark) == before
    assert [row.step for row in runs.manifest(spark, cfg).collect()] == ["reporting"]

    made.clear()
    for name in ("enrich", "features", "model_sets"):
        monkeypatch.setattr(job, name, counted(name))
    paths = job.prepare(tables, cfg)
    assert made == ["features", "model_sets", "model_sets"] and staged(spark) == before
    found = {row.step: row for row in runs.manifest(spark, cfg).collect()}
    assert set(found) == {"reporting", "enriched", "set-train_val", "set-test"}
    assert found["reporting"].row_count == found["reporting"].key_count == found["enriched"].row_count > 0
    for name, path in paths.items():
        assert found[f"set-{name}"].path == path and found[f"set-{name}"].row_count == spark.read.parquet(path).count()

    made.clear()
    assert job.prepare(tables, cfg) == paths and made == []
    assert runs.manifest(spark, replace(cfg, run_tag="other")).count() == 0


def test_steps_after_one_made_anew_are_made_anew_too(spark, cfg):
    made = []

    def run(cfg):
        one, made[:] = runs.Run(spark, cfg), []

        def step(name):
            return one.step(name, cfg.path(name), lambda: made.append(name) or spark.range(3).withColumn("x", F.lit(len(made))))

        return [step(name).count() for name in ("a", "b")]

    assert run(cfg) == [3, 3] and made == ["a", "b"]
    assert run(cfg) == [3, 3] and made == []
    other = replace(cfg, trailing_default=2.0)
    assert run(other) == [3, 3] and made == ["a", "b"]
    assert run(other) and made == []
    assert run(cfg) == [3, 3] and made == ["a", "b"]


def test_a_table_that_was_not_written_whole_is_not_taken_for_finished(spark, cfg):
    one = runs.Run(spark, cfg)
    spark.range(9).write.parquet(cfg.path("a"))
    assert one.finished("a") is None and one.step("a", cfg.path("a"), lambda: spark.range(4)).count() == 4
    with pytest.raises(ValueError, match="b: 4 rows for 2 values of k"):
        one.step("b", cfg.path("b"), lambda: spark.range(4).select((F.col("id") % 2).alias("k")), keys=["k"], unique=True)
    assert runs.Run(spark, cfg).finished("b") is None


def test_scratch_removes_what_was_staged_and_what_a_lost_driver_left(spark):
    with scratch(spark, "work"):
        left = staging_path(spark, "t")
        assert "/staged/work/t-" in left and stage(spark.range(2)).count() == 2
        with scratch(spark, "inner"):
            assert "/staged/inner/" in staging_path(spark, "t")
        assert "/staged/work/" in staging_path(spark, "t") and "inner" not in staged(spark)
    assert "work" not in staged(spark)
    spark.range(1).write.parquet(left)
    with scratch(spark, "work"):
        assert "work" not in staged(spark)
    assert "/staged/t-" in staging_path(spark, "t")


def test_a_run_needs_a_root(spark):
    with pytest.raises(ValueError, match="output_root"):
        runs.Run(spark, PipelineConfig()).finished("a")


def test_scratch_of_one_thread_leaves_others_alone(spark):
    with scratch(spark, "mine"):
        with ThreadPoolExecutor(1) as pool:
            other = pool.submit(staging_path, spark, "x").result()
            held = stage_all({"a": spark.range(3)})["a"]
        assert "/staged/mine/" not in other and "/staged/mine/" in staging_path(spark, "x")
        assert "/staged/mine/" in held.inputFiles()[0]
