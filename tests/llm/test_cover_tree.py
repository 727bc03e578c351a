"""Cover trees against all pairs: dense clusters, copies, blocks and cells of small sizes, vectors that cannot be compared."""

import math

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import cover_tree

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, cosine=0.95):
    usable = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = {k: np.array(rows[k][1], np.float32).astype(float) for k in usable}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    near = {k: [j for j in usable if j != k and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= cosine] for k in usable}
    found = []
    for k, (name, _) in enumerate(rows):
        seen, open_ = {k}, [k]
        while open_:
            for j in near.get(open_.pop(), []):
                if j not in seen:
                    seen.add(j)
                    open_.append(j)
        names = [rows[j][0] for j in seen if rows[j][0] is not None]
        found.append((name, len(near.get(k, [])), min(names) if names else None))
    return sorted(found, key=str)


def made(seed=2, clusters=6, each=25, dims=8):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(clusters):
        centre = rng.normal(size=dims)
        rows += [(centre + rng.normal(size=dims) * rng.choice([0.02, 0.1, 0.3])).tolist() for _ in range(each)]
    return [(k, v) for k, v in enumerate(rows)]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("uid", F.lit("theirs")).withColumn("root", F.lit(1)).repartition(3)
    found = [(r["vec_id"], r["n_links"], r["component_id"]) for r in cover_tree.near_duplicates(df, **options).collect()]
    assert sorted(found, key=str) == plain(rows, **options)


def test_same_as_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "SHARD", 16)
    monkeypatch.setattr(cover_tree, "BLOCK_BYTES", 3 * 8 * 8 * 16)
    monkeypatch.setattr(cover_tree, "WIDE", 20)
    check(spark, made())


def test_one_shard_and_other_threshold(spark):
    check(spark, made(5, 3, 40), cosine=0.8)


def test_copies_and_vectors_that_link_with_nothing(spark):
    rows = [(k, [1.0, 0.0, 2.0]) for k in (9, 4, 4, 7, None)] + [(1, [2.0, 0.0, 4.0]), (2, [1.0, 0.0, 2.001]), (3, [-1.0, 0.0, -2.0])]
    rows += [(10, None), (11, []), (12, [0.0, -0.0, 0.0]), (13, [1.0, None, 2.0]), (14, [float("nan"), 1.0, 1.0]), (15, [float("inf"), 1.0, 1.0]), (None, None)]
    rows += [(20, [1.0, 0.0]), (21, [1.0, 0.0]), (22, [1e30, 1e-30]), (23, [3e-38, 0.0])]
    check(spark, rows)


def test_no_rows_and_only_unusable_rows(spark):
    assert cover_tree.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [tuple(r) for r in cover_tree.near_duplicates(spark.createDataFrame([(5, None)], SCHEMA)).collect()] == [(5, 0, 5)]


def test_tree_invariants():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(300, 5))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    tree = cover_tree.Tree.grown(np.arange(300), np.ones(300, np.int64), points)
    for k in range(len(tree.centre)):
        inside = tree.points[tree.start[k] : tree.end[k]]
        assert tree.start[k] <= tree.centre[k] < tree.end[k]
        assert np.linalg.norm(inside - tree.points[tree.centre[k]], axis=1).max() <= tree.radius[k] + cover_tree.SLACK
        children = range(tree.first[k], tree.last[k])
        if children:
            assert tree.centre[k] in [tree.centre[c] for c in children]
            assert [tree.start[c] for c in children][1:] == [tree.end[c] for c in children][:-1] and (tree.start[children[0]], tree.end[children[-1]]) == (tree.start[k], tree.end[k])
            assert max(tree.radius[c] for c in children) <= max(tree.radius[k], cover_tree.SLACK)
