import pytest

from shoptrail.operators import cleaning, contracts, joins
from shoptrail.functions.columns import drop_columns_by_pattern


def test_columns(micro):
    contracts.require_columns(micro, ["user_id"])
    with pytest.raises(ValueError, match="price"):
        contracts.require_columns(micro, ["price"])


def test_non_empty(micro):
    with pytest.raises(ValueError):
        contracts.require_non_empty(micro.filter("false"))


def test_same_features(micro):
    contracts.require_same_features(micro, micro)
    with pytest.raises(ValueError):
        contracts.require_same_features(micro, micro.drop("time"))


def test_domain(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 1.0)], "label int, auc double")
    contracts.require_domain(df, ["label"], ["auc"], 2)
    with pytest.raises(ValueError, match="fewer"):
        contracts.require_domain(df, min_rows=20)
    with pytest.raises(ValueError, match="label"):
        contracts.require_domain(spark.createDataFrame([(2,)], "label int"), ["label"])


def test_resolve_column():
    columns = ["User ID", "Item-Id", "y"]
    assert contracts.resolve_column(columns, ["uid", "user_id"]) == "User ID"
    assert contracts.resolve_column(columns, ["item_id"]) == "Item-Id"
    assert contracts.resolve_column(columns, ["price"], required=False) is None
    with pytest.raises(ValueError):
        contracts.resolve_column(columns, ["price"])


def test_downcast(micro):
    types = dict(cleaning.downcast(micro).dtypes)
    assert (types["user_id"], types["behavior_type"]) == ("int", "tinyint")


def test_strict_time(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleaning.parse_time(spark.createDataFrame([("bad",)], "time string"), strict=True).collect()


def test_union_optional(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(3,)], "a int")
    assert {tuple(r) for r in joins.union_optional(a, b).collect()} == {(1, 2), (3, None)}


def test_pattern_columns(spark):
    df = spark.createDataFrame([(1, 2, 3.0, "x")], "user_id int, label int, pv double, name string")
    assert drop_columns_by_pattern(df) == ["user_id", "pv"]
