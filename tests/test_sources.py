import datetime as dt

import pytest
from pyspark.sql import types as T

from lanewise import session, sources
from lanewise.sources import TABLES
from tests.helpers import rows


def test_csv_keeps_text_and_matches_columns_by_name(spark, tmp_path):
    (tmp_path / "zips.csv").write_text("city,zip,state_id\nHilo,00501,HI\n\"A, b\",96720,\n")
    out = sources.read(spark, str(tmp_path), "csv", TABLES["zip_state"])
    assert rows(out) == [("00501", "HI"), ("96720", None)]


def test_conform_casts_and_nulls_what_does_not_parse(spark):
    df = spark.createDataFrame([("2023-01-02", "12", "x"), ("no", "1x", "y")], "DATE string, cutoff string, other string")
    schema = T.StructType([T.StructField("Cutoff", T.IntegerType()), T.StructField("date", T.DateType())])
    out = sources.conform(df, schema)
    assert out.schema == schema
    assert rows(out) == sorted([(12, dt.date(2023, 1, 2)), (None, None)], key=repr)


def test_missing_columns_are_all_named(spark):
    with pytest.raises(ValueError, match="missing columns: zip, state_id"):
        sources.conform(spark.range(1), TABLES["zip_state"])


def test_read_table(spark):
    spark.createDataFrame([("1", "AL", 5)], "zip string, state_id string, extra int").createOrReplaceTempView("zips")
    assert rows(sources.read_table(spark, "zips", TABLES["zip_state"])) == [("1", "AL")]
    assert sources.read_table(spark, "zips").columns == ["zip", "state_id", "extra"]


@pytest.mark.parametrize("format", ["parquet", "csv", "json", "orc"])
def test_round_trip(spark, tmp_path, format):
    df = spark.createDataFrame([("007", 1.5, None), ("b", None, 3)], "code string, x double, n int")
    path = sources.write(df, str(tmp_path / "out"), format=format)
    assert rows(sources.read(spark, path, format, df.schema)) == rows(df)


def test_write_spreads_over_files_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "out")
    sources.write(spark.range(1000), path, partitions=5)
    sources.write(spark.range(500), path, partitions=5)
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 5
    assert spark.read.parquet(path).count() == 500


def test_write_by_column(spark, tmp_path):
    path = sources.write(spark.range(4).selectExpr("id", "id % 2 as part"), str(tmp_path / "out"), partition_by=["part"])
    assert spark.read.parquet(path).filter("part = 1").count() == 2


def test_stage_goes_to_the_shared_folder(spark):
    staged = sources.stage(spark.range(3), name="numbers")
    assert all(session.shared_dir(spark).removeprefix("file:") in path for path in staged.inputFiles())
    assert session.shared_dir(spark) == (
        spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    )
    both = sources.stage_all({"a": spark.range(2), "b": spark.range(3)})
    assert (both["a"].count(), both["b"].count()) == (2, 3)
    assert sources.stage_all({}) == {}


def test_json_keeps_codes(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"zip": "00501", "n": 3}\n{"zip": "x"}\n')
    schema = T.StructType([T.StructField("zip", T.StringType()), T.StructField("n", T.IntegerType())])
    assert sorted(map(tuple, sources.read(spark, str(tmp_path), "json", schema).collect())) == [("00501", 3), ("x", None)]


def test_records_that_do_not_parse_go_to_a_table_of_their_own(spark, tmp_path):
    (tmp_path / "a.csv").write_text('day,zip,n\n2023-01-02,00501,1\n2023-13-02,00502,2\n\n2023-01-03,"1,2",\n,,\n')
    (tmp_path / "b.csv").write_text("day,zip,n\n2023-01-04,00503\n2023-01-05,00504,5,6\nx,00505,y\n")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("day", T.DateType()), T.StructField("zip", T.StringType())])
    good, rejected = sources.read_checked(spark, str(tmp_path), schema)
    assert good.schema == schema
    assert rows(good) == sorted([(1, dt.date(2023, 1, 2), "00501"), (None, dt.date(2023, 1, 3), "1,2"), (None, None, None)], key=repr)
    found = {row.record: (row.file.rsplit("/", 1)[1], row.reason) for row in rejected.collect()}
    assert found == {
        "2023-13-02,00502,2": ("a.csv", "does not parse: day"),
        "2023-01-04,00503": ("b.csv", "number of fields"),
        "2023-01-05,00504,5,6": ("b.csv", "number of fields"),
        "x,00505,y": ("b.csv", "does not parse: n, day"),
    }
    with pytest.raises(ValueError, match="missing columns: other"):
        sources.read_checked(spark, str(tmp_path), T.StructType([T.StructField("other", T.StringType())]))
