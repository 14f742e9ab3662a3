import pytest

from cohortline.operators import columns
from cohortline.operators.union import union_sources

ALIASES = {"gender": ("gender", "gen", "Gender", "sex", "Sex"), "age": ("age", "Age", "AGE")}


def test_first_alias_present_wins_and_is_case_sensitive():
    assert columns.resolve_header(["Sex", "AGE"], ALIASES) == ["gender", "age"]
    assert columns.resolve_header(["Sex", "gen"], ALIASES) == ["Sex", "gender"]
    assert columns.resolve_header(["SEX", "x"], ALIASES) == ["SEX", "x"]


def test_names_that_differ_in_case_only_stay_apart():
    names = columns.resolve_header(["Age", "age", "AGE"], ALIASES)
    assert names[1] == "age"
    assert len({n.lower() for n in names}) == 3


def test_frame_with_both_cases_is_usable(spark):
    names = columns.resolve_header(["Age", "age"], ALIASES)
    df = spark.createDataFrame([(1, 2)], names)
    assert df.select("age").first()[0] == 2


def test_rename_by_alias_and_union(spark, rows_of):
    a = columns.rename_by_alias(spark.createDataFrame([("m", 1)], "Sex string, Age int"), ALIASES)
    b = columns.rename_by_alias(spark.createDataFrame([(5, "f", 7)], "AGE int, gen string, z int"),
                                ALIASES)
    both = union_sources({"a": a, "b": b})
    assert rows_of(both, "source", "gender", "age", "z") == [("a", "m", 1, None), ("b", "f", 5, 7)]


def test_drop_front_features(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, y int")
    assert columns.drop_columns(df, ["a"]).columns == ["b", "c", "y"]
    with pytest.raises(ValueError):
        columns.drop_columns(df, ["nope"])
    assert columns.move_to_front(df, ["c", "b"]).columns == ["c", "b", "a", "y"]
    assert columns.feature_columns(df, "y", ["a"]) == ["b", "c"]
    assert columns.keep_columns(df, ["y", "a"]).columns == ["y", "a"]
