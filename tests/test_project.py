import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.casting import (
    blank_to_null, cast_can_fail, can_cast, default_literal, safe_cast, spark_type, text_to_integer,
)
from plumbline.operators.project import INVALID_FIELDS, check_template, fill_name, project_to_template, union_tables


def values(spark, texts, sql):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(F.expr(sql)).collect()]


@pytest.mark.parametrize("name,kind", [
    ("string", T.StringType()), ("MainData", T.StringType()), ("iotsignal", T.StringType()), ("iotsynoptic", T.StringType()),
    ("DATE", T.TimestampType()), ("double", T.DoubleType()), ("Integer", T.IntegerType()), ("boolean", T.BooleanType()),
])
def test_type_names_ignore_case(name, kind):
    assert spark_type(name) == kind


@pytest.mark.parametrize("name", [None, "", "decimal"])
def test_other_type_names_are_errors(name):
    with pytest.raises(ValueError, match="Unsupported"):
        spark_type(name)


def test_integer_text_reads_like_the_old_cast(spark):
    cases = {"1": 1, "1.": 1, "+.": 0, ".": 0, "": None, "+": None, "-": None, "-.5": 0, ".5": 0, "\t7\t": 7, "\xa07": None,
             "1_0": None, "2147483648": None, "-2147483648.9": -2147483648, "3.7": 3, "-3.9": -3, "3e2": None, " 4 ": 4,
             "+4": 4, "1.5.2": None, "\x0b9\x7f": 9}
    assert dict(zip(cases, values(spark, list(cases), text_to_integer("s")))) == cases
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert dict(zip(cases, values(spark, list(cases), "CAST(s AS int)"))) == cases
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_casts_do_not_depend_on_ansi_mode(spark):
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        assert values(spark, ["x", "2.5", ""], safe_cast("s", T.StringType(), "double")) == [None, 2.5, None]
        assert values(spark, ["1"], safe_cast("3000000000L", T.LongType(), "integer")) == [None]
    spark.conf.set("spark.sql.ansi.enabled", "true")


def test_pairs_that_cannot_be_cast_become_null(spark):
    pairs = {(T.DateType(), "integer"), (T.DateType(), "double"), (T.BooleanType(), "date"), (T.BinaryType(), "integer")}
    for source, name in pairs:
        assert not can_cast(source, spark_type(name))
        assert safe_cast("x", source, name).startswith("CAST(NULL")
    assert not cast_can_fail(T.IntegerType(), "double") and cast_can_fail(T.LongType(), "integer")
    # Every pair said to be castable must pass analysis.
    literals = {T.StringType(): "'1'", T.LongType(): "1L", T.DoubleType(): "1D", T.BooleanType(): "true",
                T.DateType(): "date'2020-01-01'", T.TimestampType(): "timestamp'2020-01-01'",
                T.TimestampNTZType(): "timestamp_ntz'2020-01-01'", T.BinaryType(): "X'01'", T.DecimalType(5, 2): "1.50",
                T.ArrayType(T.LongType()): "array(1L)"}
    for source, literal in literals.items():
        for name in ("string", "date", "double", "integer", "boolean"):
            spark.sql(f"SELECT {safe_cast(literal, source, name)}").collect()


def test_blank_is_spaces_only(spark):
    assert values(spark, ["", "   ", "\t", " a "], blank_to_null("s")) == [None, None, "\t", " a "]
    assert blank_to_null("n", T.LongType()) == "n"


@pytest.mark.parametrize("value,kind,expected", [
    (42, "integer", 42), ("3.7", "integer", 3), (3.9, "integer", 3), (3.14, "double", 3.14), ("x", "double", None),
    (True, "boolean", True), ("yes", "boolean", True), ("Y", "boolean", True), (1, "boolean", True), ("no", "boolean", False),
    (0, "boolean", False), (None, "integer", None), (7, "string", "7"), ("it's \\ here", "string", "it's \\ here"),
    ("2022-01-01", "date", datetime.datetime(2022, 1, 1)), ("never", "date", None), (5, "double", 5.0),
])
def test_default_literals(spark, value, kind, expected):
    df = spark.range(1).select(F.expr(default_literal(value, kind)).alias("v"))
    assert df.schema["v"].dataType == spark_type(kind) and df.first()["v"] == expected


def test_unknown_boolean_default_is_an_error():
    with pytest.raises(ValueError, match="maybe"):
        default_literal("maybe", "boolean")


SCHEMA = [
    {"code": "A", "type": "Integer"}, {"code": "B", "type": "string"}, {"code": "C", "type": "double"}, {"code": "D", "type": "date"},
]
MAPPING = {"A": {"field": "raw", "default_value": 9}, "B": {"field": "raw", "default_value": None},
           "C": {"field": "absent", "default_value": 1.5}}


def test_projection(spark):
    df = spark.createDataFrame([("1", " 5 "), ("2", "x"), ("3", " "), ("4", None)], "id string, raw string")
    out = project_to_template(df, ["id", "name"], SCHEMA, MAPPING)
    assert out.columns == ["id", "name", "A", "B", "C", "D", INVALID_FIELDS]
    rows = [tuple(r) for r in out.orderBy("id").collect()]
    assert rows == [("1", None, 5, " 5 ", 1.5, None, []), ("2", None, None, "x", 1.5, None, ["A"]),
                    ("3", None, 9, None, 1.5, None, []), ("4", None, 9, None, 1.5, None, [])]


def test_column_presence_is_case_sensitive(spark):
    df = spark.createDataFrame([("1", "5")], "id string, RAW string")
    assert project_to_template(df, ["id"], SCHEMA[:1], MAPPING).first()["A"] == 9


def test_odd_column_names(spark):
    df = spark.createDataFrame([("5",)], "`a.b``c` string")
    out = project_to_template(df, ["a.b`c"], [{"code": "it's.x", "type": "integer"}], {"it's.x": {"field": "a.b`c"}})
    assert tuple(out.first()) == ("5", 5, [])
    bad = project_to_template(df.withColumn("a.b`c", F.lit("q")), [], [{"code": "it's.x", "type": "integer"}],
                              {"it's.x": {"field": "a.b`c"}})
    assert bad.first()[INVALID_FIELDS] == ["it's.x"]


def test_empty_template_has_a_typed_invalid_list(spark):
    out = project_to_template(spark.range(1), ["id"], [], {})
    assert out.schema[INVALID_FIELDS].dataType.simpleString() == "array<string>"


@pytest.mark.parametrize("schema", [[{"type": "string"}], [{"code": "ID", "type": "string"}],
                                    [{"code": "A", "type": "string"}, {"code": "a", "type": "string"}]])
def test_bad_codes_are_errors(schema):
    with pytest.raises(ValueError):
        check_template(["id"], schema)


def test_wide_template_is_one_projection(spark):
    schema = [{"code": f"c{i}", "type": ("integer", "double", "string", "date")[i % 4]} for i in range(300)]
    mapping = {c["code"]: {"field": "raw", "default_value": None} for c in schema}
    df = project_to_template(spark.createDataFrame([("7",)], "raw string"), [], schema, mapping)
    assert df.first()["c0"] == 7 and len(df.columns) == 301


def test_union_widens_and_checks(spark):
    a = spark.createDataFrame([(1, "x")], "id bigint, v string")
    b = spark.createDataFrame([("z", "y")], "v string, id string").select("id", "v")
    assert {tuple(r) for r in union_tables([a, b]).collect()} == {("1", "x"), ("y", "z")}
    with pytest.raises(ValueError, match="other"):
        union_tables([a, a.withColumnRenamed("v", "other")])
    assert union_tables([a, a]).count() == 2


def test_fill_name(spark):
    df = spark.createDataFrame([(1, None), (2, "  "), (3, "\t"), (None, None), (5, "n")], "id bigint, name string")
    assert {r["id"]: r["name"] for r in fill_name(df).collect()} == {1: "1", 2: "2", 3: "\t", None: None, 5: "n"}
    assert fill_name(df.drop("name")).filter("id = 1").first()["name"] == "1"


def test_wide_template_computes_each_cast_once(spark):
    """A source field under many characteristics is cast once for each type; core fields may be named like working columns."""
    df = spark.createDataFrame([(1, " 3.7 ", "k"), (2, "x", "k"), (3, " ", None), (4, None, "k")], "id int, s string, _of_source_0 string")
    kinds = ["integer", "double", "string"]
    characteristics = [{"code": f"c{k}", "type": kinds[k % 3]} for k in range(300)]
    mapping = {f"c{k}": {"field": "s", "default_value": 9 if k == 0 else None} for k in range(300)}
    wide = project_to_template(df, ["id", "_of_source_0"], characteristics, mapping)
    assert wide.columns == ["id", "_of_source_0", *[f"c{k}" for k in range(300)], "_invalid_type_fields"]
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("cast(") < 20
    rows = {r["id"]: r for r in wide.collect()}
    assert [rows[1][f"c{k}"] for k in range(3)] == [3, 3.7, " 3.7 "] and rows[1]["_invalid_type_fields"] == []
    assert rows[2]["_invalid_type_fields"] == [f"c{k}" for k in range(300) if k % 3 < 2] and rows[2]["c299"] == "x"
    assert (rows[3]["c0"], rows[3]["c3"], rows[4]["c0"], rows[4]["c2"]) == (9, None, 9, None)
    assert [rows[k]["_of_source_0"] for k in (1, 2, 3, 4)] == ["k", "k", None, "k"]
