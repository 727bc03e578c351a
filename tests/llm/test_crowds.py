"""Crowded buckets: no link lost against all pairs, and far fewer rows than pairs."""

import random

import pytest

from plumbline.llm import bag_minhash, crowds
from plumbline.llm.bag_minhash import near_duplicates
from tests.llm.test_bag_minhash import brute_force, varied


def two_families(seed):
    """Around two bases, one made from the other, with few to very many changes, exact copies, repeated words, and a shared passage."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(100)]
    other = base[:60] + [f"o{rnd.randrange(10**6)}" for _ in range(50)]
    rows = [(k, varied(rnd, base if k % 3 else other, rnd.randrange(0, 9))) for k in range(150)]
    rows += [(200 + k, " ".join([*base[:70], *(f"x{rnd.randrange(10**6)}" for _ in range(rnd.randrange(5, 40)))])) for k in range(40)]
    rows += [(300 + k, " ".join(base[:50]) + " a a a a a a" * (k % 7) + f" end{k % 4}") for k in range(40)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_crowds_lose_no_link(spark, documents, monkeypatch, seed):
    monkeypatch.setattr(bag_minhash, "CROWD", 2)
    rows = two_families(seed)
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(documents(rows), bands=60, band_rows=2).collect()}
    assert got == brute_force(rows)


def test_candidates_hold_every_pair_or_its_hub(spark):
    """Sets of numbers around a common ground, each its own component: pairs at 0.8 or more are returned, or both with one hub."""
    rnd = random.Random(5)
    ground = set(range(60))
    sets = [(ground - set(rnd.sample(range(60), k % 12))) | {rnd.randrange(100, 160) for _ in range(k % 9)} for k in range(90)]
    ref = sets[11]
    differing = spark.createDataFrame([(0, k, len(s), sorted(s ^ ref)) for k, s in enumerate(sets)], "ref long, id long, n long, units array<long>")
    members = spark.createDataFrame([(0, k, k) for k in range(90)], "ref long, id long, root long")
    pairs = {(r["a"], r["b"]) for r in crowds.candidates(differing, members, 0.8).collect()}
    held = {k: {b if a == k else a for a, b in pairs if k in (a, b)} for k in range(90)}
    for a in range(90):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                assert (a, b) in pairs or any(len(sets[x] & sets[h]) >= 0.8 * len(sets[x] | sets[h]) for x in (a, b) for h in held[a] & held[b])
    assert len(pairs) < 90 * 89 / 4
    assert crowds.candidates(differing.limit(0), members.limit(0), 0.8).count() == 0


def test_spread_crowd_makes_few_candidates(spark):
    """Half of a crowd is too far from everything: nearly no pair of it is returned."""
    rnd = random.Random(6)
    ground = set(range(130))
    sets = [(ground - set(rnd.sample(range(130), k % 40))) | {1000 + 50 * k + j for j in range(k % 40)} for k in range(400)]
    differing = spark.createDataFrame([(0, k, len(s), sorted(s ^ ground)) for k, s in enumerate(sets)], "ref long, id long, n long, units array<long>")
    members = spark.createDataFrame([(0, k, k) for k in range(400)], "ref long, id long, root long")
    assert crowds.candidates(differing, members, 0.8).count() < 2000


def test_differences_of_one_member_or_of_most_are_no_rows(spark, monkeypatch):
    """Each member lacks what most lack of ref, has own units, and a few have one in common: only the last are counted and joined."""
    ref = set(range(50))
    sets = [set(range(20, 50)) | {1000 + 50 * k + j for j in range(30)} | ({500} if k < 3 else set()) for k in range(60)]
    differing = spark.createDataFrame([(0, k, len(s), sorted(s ^ ref)) for k, s in enumerate(sets)], "ref long, id long, n long, units array<long>")
    made = {}

    def counted(df, name, staged=crowds.staged):
        out = staged(df, name)
        made[name] = out
        return out

    monkeypatch.setattr(crowds, "staged", counted)
    got = {r["id"]: r["d"] for r in crowds.grounded(differing).collect()}
    assert made["crowd-units"].count() == 21
    assert made["crowd-differences"].selectExpr("sum(size(asked))").first()[0] < 60  # 3, and what the filter lets through
    for k, s in enumerate(sets):
        assert [d & ((1 << 56) - 1) for d in got[k]] == sorted(s - set(range(20, 50)) - {500}) + [500] * (500 in s)
        assert sum(d >> 56 for d in got[k]) == (3 if 500 in s else 0)  # 2 log2(3), rounded down


def test_differences_are_counted_in_packets(spark, monkeypatch):
    """Of two crowds with their own counts, no row is made for each unit before the shuffle, and none at all for what one member has."""
    monkeypatch.setattr(crowds, "PACKET_UNITS", 1000)
    rows = [(ref, k, 1, [ref + 5, 10**6 + 1000 * k + ref, *range(100, 100 + k % 20)]) for ref in (0, 1) for k in range(200)]
    differing = spark.createDataFrame(rows, "ref long, id long, n long, units array<long>").repartition(8, "id")
    made = {}

    def counted(df, packets, packed=crowds.packed):
        out = packed(df, packets)
        made[packets] = out.count()
        return out

    monkeypatch.setattr(crowds, "packed", counted)
    got = {(r["ref"], r["unit"]): r["c"] for r in crowds.tallied(differing).collect()}
    assert got == {(ref, ref + 5): 200 for ref in (0, 1)} | {(ref, 100 + j): 200 - 10 * (j + 1) for ref in (0, 1) for j in range(19)}
    assert list(made) == [5] and made[5] <= 8 * 5  # 400 units of one member, and 40 others in each partition, before
    assert crowds.tallied(differing.limit(0)).count() == 0
