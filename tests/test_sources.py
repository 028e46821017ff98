import pytest

from shoptrail.operators import classifiers, marts
from shoptrail.plans import stages
from shoptrail.sources import tables as io

HEADER = "user_id,item_id,behavior_type,item_category,time\n"


@pytest.fixture()
def csv(tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(HEADER + "1,10,1,2,2024-01-01 08:00:00\n1,10,1,2,2024-01-01 08:00:00\nx,10,1,2,2024-01-01 08:00:00\n2,11,4,3,\n")
    return str(path)


def test_csv(spark, csv):
    df = io.scan_csv(spark, csv, corrupt_column="_bad").cache()
    assert df.count() == 4
    assert [r["_bad"] for r in df.filter("_bad is not null").collect()] == ["x,10,1,2,2024-01-01 08:00:00"]
    assert io.scan_csv_preview(spark, csv, 2).count() == 2


def test_parallel_read(spark, csv, tmp_path):
    out = str(tmp_path / "clean")
    clean = stages.run_parallel_read(spark, csv, out)
    assert [tuple(r)[:2] for r in clean.collect()] == [(1, 10)]


def test_tables(spark, micro, tmp_path):
    io.write_parquet(micro, str(tmp_path / "events.parquet"))
    io.write_csv(micro, str(tmp_path / "events.csv"), single_file=True)
    assert io.read_table(spark, str(tmp_path / "events.parquet")).count() == 11
    assert io.read_table(spark, str(tmp_path / "events.csv")).count() == 11
    with pytest.raises(ValueError):
        io.read_table(spark, "events.xls")
    scan = io.scan_columns(spark, str(tmp_path / "events.parquet"), ["user_id", "time"])
    assert "ReadSchema: struct<user_id:bigint,time:timestamp_ntz>" in scan._jdf.queryExecution().executedPlan().toString()


def test_star_schema_files(spark, micro, tmp_path):
    io.publish_star_schema(marts.star_schema(micro), str(tmp_path / "star"))
    assert io.query_sql(spark, "select count(*) as n from fact_user_behavior").first().n == 11


def test_model_files(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i), int(i > 5)) for i in range(12)], "user_id long, x double, label int")
    model = classifiers.train_logistic(df, ["x"])
    io.save_model(model, str(tmp_path / "model"))
    again = io.load_model(str(tmp_path / "model"))
    assert classifiers.score(again, df).collect() == classifiers.score(model, df).collect()
