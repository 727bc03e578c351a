import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions.geometry import GEOMETRY
from plumbline.functions.text import is_usable
from plumbline.operators.metrics import failing_gate, outcome_counts, quarantined_share, roll_up, with_ratio
from plumbline.operators.skew import lookup_join, mark_members
from plumbline.operators.validate import Rules, classify, duplicate_keys, mark_duplicates, split
from tests.test_geometry import BOW_TIE, polygon, square

SCHEMA = f"row int, id string, name string, geom {GEOMETRY.simpleString()}, _invalid_type_fields array<string>"


def staged(rows, mandatory):
    """The rules applied one after the other to what is left, in plain Python."""
    out, left = {}, list(rows)
    for r in list(left):
        if r[4]:
            out[r[0]] = ("invalid_type", ",".join(r[4]))
    left = [r for r in left if r[0] not in out]
    for r in left:
        missing = [f for f, v in (("id", r[1]), ("name", r[2])) if f in mandatory and v is None]
        if missing:
            out[r[0]] = ("required_field_missing", ",".join(missing))
    left = [r for r in left if r[0] not in out]
    ids = [r[1] for r in left if r[1] is not None]
    for r in left:
        if r[1] is not None and ids.count(r[1]) > 1:
            out[r[0]] = ("duplicated_id", "id")
    left = [r for r in left if r[0] not in out]
    for r in left:
        if r[3] is not None and r[3]["parts"][0][0] == BOW_TIE:
            out[r[0]] = ("invalid_geometry", "geom")
    return out


def random_rows(count, seed=3):
    rng = random.Random(seed)
    return [
        (i, rng.choice([None, "", *[f"a{k}" for k in range(count // 2)]]), rng.choice([None, "n", ""]),
         rng.choice([None, polygon(square(0, 0)), polygon(BOW_TIE)]), rng.choice([[], [], [], ["A"], ["A", "B"]]))
        for i in range(count)
    ]


@pytest.mark.parametrize("mandatory", [("id", "name"), ("name",), ()])
@pytest.mark.parametrize("max_bytes", [1 << 25, -1])
def test_one_pass_equals_the_staged_rules(spark, mandatory, max_bytes):
    rows = random_rows(300)
    df = spark.createDataFrame(rows, SCHEMA)
    done = classify(df, Rules(mandatory=mandatory), max_bytes)
    assert done.columns == ["row", "id", "name", "geom", "reject"]
    got = {r["row"]: (r["reject"]["code"], r["reject"]["field"]) for r in done.collect() if r["reject"]}
    assert got == staged(rows, mandatory)
    valid, rejected = split(done)
    assert valid.count() + rejected.count() == 300 and valid.columns == ["row", "id", "name", "geom"]


def test_an_earlier_reject_frees_its_twin(spark):
    rows = [(1, "a", "n", None, ["X"]), (2, "a", "n", None, []), (3, "b", "n", polygon(BOW_TIE), []), (4, "b", "n", None, [])]
    done = classify(spark.createDataFrame(rows, SCHEMA), Rules())
    assert {r["row"]: r["reject"] and r["reject"]["code"] for r in done.collect()} == {
        1: "invalid_type", 2: None, 3: "duplicated_id", 4: "duplicated_id"}


def test_null_ids_are_no_duplicates_and_blank_ids_are_ids(spark):
    rows = [(1, None, "n", None, []), (2, None, "n", None, []), (3, "", "n", None, []), (4, "", "n", None, [])]
    done = classify(spark.createDataFrame(rows, SCHEMA), Rules(mandatory=("name",)))
    assert {r["row"] for r in done.filter("reject IS NOT NULL").collect()} == {3, 4}


def test_the_invalid_column_is_optional(spark):
    df = spark.createDataFrame(random_rows(20), SCHEMA).drop("_invalid_type_fields")
    assert classify(df, Rules()).columns == ["row", "id", "name", "geom", "reject"]


def test_missing_columns_are_listed(spark):
    with pytest.raises(ValueError, match=r"\['geom', 'name'\]"):
        classify(spark.range(1), Rules())


def test_hot_id_takes_the_broadcast_also_when_the_key_set_is_large(spark):
    """A third of the rows share one id and a third have none; beyond the size bound both ways must agree."""
    df = spark.range(30_000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.floor(F.col("id") / 6))).alias("id"),
    )
    small, large = mark_duplicates(df, "id"), mark_duplicates(df, "id", max_bytes=-1)
    expected = {(r["row"], r["is_duplicate"]) for r in small.collect()}
    assert {(r["row"], r["is_duplicate"]) for r in large.collect()} == expected and large.count() == 30_000
    assert duplicate_keys(df, "id").filter("id = 'hot'").first()["n"] == 10_000
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Range (0, 30000") == 1  # one scan, and no wide row is shuffled
    assert "Exchange hashpartitioning" not in large._jdf.queryExecution().executedPlan().toString()


def test_large_set_without_hot_keys(spark, monkeypatch):
    monkeypatch.setattr("plumbline.operators.skew.HOT_KEYS", 2)
    df = spark.range(1000).select(F.floor(F.col("id") / 3).alias("id"), (F.col("id") % 2 == 0).alias("use"))
    keys = df.filter("use").groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    marks = [mark_members(df, keys, "id", F.col("use"), "m", bound).orderBy("id", "use").collect() for bound in (1 << 20, -1)]
    assert marks[0] == marks[1]
    # Crowded bitmaps: several levels, and a sieve that does not shrink.
    for bits, rest, sieved in ((9, 2000, True), (9, 0, None), (1, 0, False)):
        monkeypatch.setattr("plumbline.operators.skew.BITMAP_BITS", bits)
        monkeypatch.setattr("plumbline.operators.skew.MAX_BROADCAST_BYTES", rest)
        found = mark_members(df, keys, "id", F.col("use"), "m", -1)
        assert found.orderBy("id", "use").collect() == marks[0]
        assert sieved is None or ("Union" in found._jdf.queryExecution().optimizedPlan().toString()) is not sieved


@pytest.mark.parametrize("may_be_hot", [True, False])
def test_lookup_join_both_ways(spark, may_be_hot):
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
                                  .otherwise((F.col("id") % 50).cast("string")).alias("v"))
    index = spark.createDataFrame([("hot", 1, "x"), ("2", 2, None), ("5", None, "z"), ("unused", 9, "q")], "v string, a int, b string")
    ways = [lookup_join(df, F.col("v"), index, "v", F.xxhash64("id"), may_be_hot, bound) for bound in (1 << 20, -1)]
    assert ways[0].columns == ways[1].columns == ["id", "v", "a", "b"]
    assert sorted(map(tuple, ways[0].collect())) == sorted(map(tuple, ways[1].collect()), key=lambda r: r)


def test_rows_without_a_lookup_are_dealt_out(spark):
    """All rows that search nothing, and those of a hot value, must not meet in one shuffle partition."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, "hot").alias("v"))
        index = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("v"), "id").withColumnRenamed("id", "a")
        found = lookup_join(df, F.col("v"), index, "v", F.xxhash64("id"), True, -1)
        spread = found.groupBy(F.spark_partition_id().alias("p"), F.col("v").isNull()).count().collect()
        assert len(spread) == 8 and max(r["count"] for r in spread) < 700
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_usable_values(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in df.select(is_usable(F.col("v"), floating=True)).collect()] == [True, False, False]
    assert df.select(is_usable(F.lit("NaN"))).first()[0]


@pytest.mark.parametrize("written,quarantined,fails", [(8, 2, False), (4, 6, True), (0, 0, False), (79, 21, True)])
def test_gate_is_strict(spark, written, quarantined, fails):
    share = quarantined_share({"written": written, "quarantined": quarantined})
    assert (share > 0.2) is fails
    df = spark.createDataFrame([("t", written, quarantined)], "template string, written bigint, quarantined bigint")
    assert (failing_gate(df, 0.2).count() == 1) is fails
    assert with_ratio(df).first()["quarantine_ratio"] == share


def test_roll_up(spark):
    df = spark.createDataFrame([("a", 3, 1), ("b", 5, 1)], "template string, written bigint, quarantined bigint")
    assert tuple(roll_up(df).first()) == (8, 2, 10, 0.8)
    assert tuple(roll_up(df.limit(0)).first()) == (0, 0, 0, 0.0)


def test_counts_per_template(spark):
    done = classify(spark.createDataFrame(random_rows(50), SCHEMA), Rules()).withColumn("template", F.lit("t"))
    row = outcome_counts(done, ["template"]).first()
    assert row["written"] + row["quarantined"] == 50
