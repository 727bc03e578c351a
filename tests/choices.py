
from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from bench import session  # noqa: E402
from plumbline.functions.geometry import translate  # noqa: E402
from plumbline.operators.validate import Rules, classify, duplicate_keys, mark_duplicates, split  # noqa: E402
from registry.inputs import points, rings, table  # noqa: E402


def timed(run):
    run()
    times = []
    for _ in range(5):
        started = time.perf_counter()
        run()
        times.append(time.perf_counter() - started)
    return f"{statistics.median(times):.2f} | {min(times):.2f}-{max(times):.2f}"


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def lines(spark, sf_dir):
    ids = "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE concat_ws('-', l_orderkey, l_linenumber) END AS id"
    wrong = "array_compact(array(CASE WHEN l_suppkey % 31 = 0 THEN 'A' END)) AS _invalid_type_fields"
    df = table(spark, sf_dir, "lineitem").selectExpr(ids, "l_returnflag AS name", "*", wrong)
    return df.withColumn("geom", F.lit(None).cast("int"))


def two_frames(df):
    """The rules as separate frames, each sink reading its own plan."""
    valid = df.filter(F.size("_invalid_type_fields") == 0)
    rejected = [df.filter(F.size("_invalid_type_fields") > 0)]
    rejected.append(valid.filter("id IS NULL OR name IS NULL"))
    valid = valid.filter("NOT (id IS NULL OR name IS NULL)")
    twice = valid.groupBy("id").count().filter("count > 1").select("id")
    rejected.append(valid.join(twice, "id").select(*df.columns))
    valid = valid.join(twice, "id", "left_anti").select(*df.columns)
    return valid, rejected[0].unionByName(rejected[1]).unionByName(rejected[2])


def window_mark(df):
    n = F.count(F.lit(1)).over(Window.partitionBy("id"))
    return df.withColumn("is_duplicate", F.col("id").isNotNull() & (n > 1))


def arrow_translate(dx, dy):
    def move(parts: pa.Array) -> pa.Array:
        rings_ = parts.flatten()
        lines_ = rings_.flatten()
        points_ = lines_.flatten()
        values = points_.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2) + np.array([dx, dy])
        out = pa.array(values.ravel())
        for level in (points_, lines_, rings_):
            out = pa.ListArray.from_arrays(level.offsets, out)
        return pa.ListArray.from_arrays(parts.offsets, out, mask=parts.is_null())

    return F.arrow_udf(move, "array<array<array<array<double>>>>")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = session(8)
    df = lines(spark, sf_dir)
    rules = Rules(core_fields=("id", "name"))

    def one_pass():
        drain(classify(df, rules))

    def staged():
        for side in two_frames(df):
            drain(side)

    one = split(classify(df, rules))
    two = two_frames(df)
    assert [x.count() for x in one] == [x.count() for x in two]
    print("one-pass classification |", timed(one_pass), flush=True)
    print("two frames, one write each |", timed(staged), flush=True)

    keyed = df.select("id", "name", "l_comment" if "l_comment" in df.columns else "l_shipdate", "l_extendedprice")
    assert mark_duplicates(keyed, "id").filter("is_duplicate").count() == window_mark(keyed).filter("is_duplicate").count()
    print("duplicates: keys settled, then joined |", timed(lambda: drain(mark_duplicates(keyed, "id"))), flush=True)
    print("duplicates: same, beyond the size bound |", timed(lambda: drain(mark_duplicates(keyed, "id", max_bytes=-1))), flush=True)
    plain = lambda: drain(keyed.join(duplicate_keys(keyed, "id").withColumnRenamed("id", "k"), F.col("id") == F.col("k"), "left"))
    print("duplicates: plain join, one query |", timed(plain), flush=True)
    print("duplicates: window over whole rows |", timed(lambda: drain(window_mark(keyed))), flush=True)

    for name, shapes in (("points", points(spark, sf_dir)), ("polygons", rings(spark, sf_dir))):
        jvm = shapes.select(translate("geom", 2.0, -3.0)["parts"].alias("p"))
        arrow = shapes.select(arrow_translate(2.0, -3.0)("geom.parts").alias("p"))
        assert jvm.exceptAll(arrow).isEmpty()
        print(f"translate {name}: higher-order functions |", timed(lambda: drain(jvm)), flush=True)
        print(f"translate {name}: Arrow function |", timed(lambda: drain(arrow)), flush=True)


if __name__ == "__main__":
    main()
