"""Components and split allocation."""

from __future__ import annotations

import time
import random

from pyspark.sql import functions as F

import pytest

from assayweave.llm import splits

ROWS = "release_id long, split string, endpoint string, pmcid string, author_id string, scaffold string, inchikey string"


def union_find(rows):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for row in rows:
        if row[0] is None:
            continue
        for k, v in zip(splits.KEYS, row[3:]):
            if v and not (k == "scaffold" and v == "acyclic"):
                parent[find((k, v))] = find(row[0])
        find(row[0])
    return {row[0]: find(row[0]) for row in rows if row[0] is not None}


def rows_of(seed, n, keys=40):
    rng = random.Random(seed)
    pick = lambda p: rng.choice([None, "", f"{p}{rng.randint(0, keys)}"])
    return [(i, rng.choice(["train", "Train", "val", "valid", "test", None, ""]), rng.choice(["Ki", "IC50", None]), pick("p"), pick("a"), rng.choice([pick("s"), "acyclic"]), pick("i")) for i in range(n)]


def test_components_match_union_find(spark):
    chain = [(1000 + i, "train", "Ki", f"c{i}", f"c{i + 1}" if i % 2 else None, None, None) for i in range(3)] + [(2000 + i, None, "Ki", f"x{i // 2}", None, f"y{(i + 1) // 2}", None) for i in range(60)]
    for rows in (rows_of(1, 150), rows_of(2, 80, keys=200), chain):
        found = {r["release_id"]: r["component"] for r in splits.grouped(spark.createDataFrame(rows, ROWS), "release_id").collect()}
        want = union_find(rows)
        groups = lambda m: {frozenset(k for k in m if m[k] == c) for c in set(m.values())}
        assert groups(found) == groups(want)


def test_parted_rows_match_brute_force(spark):
    rows = rows_of(3, 200, keys=120) + [(0, "test", None, None, None, None, None), (None, "test", "Ki", "p1", None, None, None)]
    name = lambda s: {"val": "valid", "": None}.get(s.lower().strip(), s.lower().strip()) if s is not None else None
    of = union_find(rows)
    seen = {}
    for r in rows:
        if r[0] is not None and name(r[1]):
            seen.setdefault(of[r[0]], set()).add(name(r[1]))
    want = {r[0] for r in rows if r[0] is not None and name(r[1]) and len(seen[of[r[0]]]) > 1}
    df = spark.createDataFrame(rows, ROWS).withColumns({"u": F.lit(1), "component": F.lit(2), "k": F.lit(3)})
    assert {r["release_id"] for r in splits.parted_rows(df).collect()} == want
    assert splits.parted_rows(df.limit(0)).count() == 0


def test_assignment_keeps_components_and_quotas(spark):
    rng = random.Random(4)
    rows = [(i, "train", rng.choice(["Ki", "IC50"]), f"p{i // rng.choice([1, 1, 2, 5])}" if i > 100 else f"big{i // 40}", None, None, None) for i in range(700)] + [(700, None, None, None, None, None, None)]
    out = splits.assign_splits(spark.createDataFrame(rows, ROWS)).collect()
    assert len(out) == 701 and len({r["release_id"] for r in out}) == 701
    by = {}
    for r in out:
        by.setdefault(r["component"], set()).add(r["split"])
    assert all(len(s) == 1 for s in by.values())
    share = {s: sum(r["split"] == s for r in out) / len(out) for s in ("train", "valid", "test")}
    assert abs(share["train"] - 0.8) < 0.01 and abs(share["valid"] - 0.1) < 0.01 and abs(share["test"] - 0.1) < 0.01
    assert splits.assign_splits(spark.createDataFrame([], ROWS)).count() == 0


def test_allocation_rounds_to_whole_components():
    plan = splits.allocate([(50, 0, 1), (1, 0, 40), (5, 1, 2)])
    assert {k: sum(v) for k, v in plan.items()} == {(50, 0): 1, (1, 0): 40, (5, 1): 2}
    assert plan[50, 0] == [1, 0, 0]
    filled = [sum(s * v[k] for (s, _), v in plan.items()) for k in range(3)]
    assert filled == [80, 10, 10]
    assert splits.allocate([]) == {}


def test_ranks_of_a_large_group(spark):
    df = spark.range(500).select(F.lit("g").alias("g"), F.col("id"))
    out = splits.ranked(df, ["g"], ["id"], salts=7).toPandas()
    assert sorted(out["rank"]) == list(range(500))


def test_allocation_is_quick_and_even_for_many_bundles():
    rng = random.Random(2)
    bundles = [(s, p, n) for (s, p), n in {(rng.randint(1, 2000), rng.randint(0, 200)): rng.randint(1, 20) for _ in range(100_000)}.items()]
    began = time.process_time()
    plan = splits.allocate(bundles)
    assert time.process_time() - began < 10
    total = sum(s * n for s, _, n in bundles)
    rows = [sum(given[k] * s for (s, _), given in plan.items()) for k in range(3)]
    assert all(sum(plan[s, p]) == n for s, p, n in bundles)
    assert all(abs(mine - total * share) <= 2 for mine, (_, share) in zip(rows, splits.QUOTAS))


@pytest.mark.parametrize(
    ("bundles", "plan"),
    [
        ([(1, 0, 1000)], {(1, 0): [800, 100, 100]}), ([(60, 0, 1), (30, 0, 1), (1, 0, 10)], {(60, 0): [1, 0, 0], (30, 0): [1, 0, 0], (1, 0): [0, 5, 5]}), ([(100, 0, 3)], {(100, 0): [3, 0, 0]}),
        ([(50, 1, 2), (1, 0, 900)], {(50, 1): [2, 0, 0], (1, 0): [700, 100, 100]}),
    ],
)
def test_small_allocations(bundles, plan):
    assert splits.allocate(bundles) == plan


def test_hot_keys_and_many_profiles_change_nothing(spark, monkeypatch):
    rows = [(n, None if n % 3 else "hub", f"a{n % 40}", None, None, f"e{n % 7}") for n in range(300)] + [(1000 + n, f"p{n // 2}", None, None, None, f"x{n % 5}") for n in range(300)]
    df = spark.createDataFrame(rows, "release_id long, pmcid string, author_id string, scaffold string, inchikey string, endpoint string")
    plain = {r["release_id"]: r["component"] for r in splits.grouped(df).collect()}
    monkeypatch.setattr(splits, "HOT", 20)
    monkeypatch.setattr(splits, "MOST_PROFILES", 2)
    assert {r["release_id"]: r["component"] for r in splits.grouped(df).collect()} == plain
    for most in (1000, 1):
        monkeypatch.setattr(splits, "MOST_BUNDLES", most)
        out = splits.assign_splits(df).collect()
        assert len(out) == 600 and all(len({r["split"] for r in out if r["component"] == c}) == 1 for c in set(plain.values()))


def test_assignment_does_not_depend_on_limits(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(n, rng.choice(["Ki", "IC50", "Kd", None]), f"p{n // rng.choice([1, 2, 3])}" if n > 60 else "big") for n in range(600)]
    df = spark.createDataFrame(rows, "release_id long, endpoint string, pmcid string").withColumns({k: F.lit(None).cast("string") for k in splits.KEYS[1:]})
    plain = sorted(map(tuple, splits.assign_splits(df).collect()))
    for name, small in (("MOST_BUNDLES", 1), ("MOST_PROFILES", 2), ("PER_SALT", 40)):
        with monkeypatch.context() as limits:
            limits.setattr(splits, name, small, raising=False)
            assert sorted(map(tuple, splits.assign_splits(df).collect())) == plain, name


def test_every_profile_is_balanced_however_many_there_are(spark):
    rows = [(n, f"e{n % 400}", "big" if n % 400 == 7 else None) for n in range(8000)]
    df = spark.createDataFrame(rows, "release_id long, endpoint string, pmcid string").withColumns({k: F.lit(None).cast("string") for k in splits.KEYS[1:]})
    of = {r["release_id"]: r["split"] for r in splits.assign_splits(df).collect()}
    assert [sum(s == name for s in of.values()) for name, _ in splits.QUOTAS] == [6400, 800, 800]
    for e in set(range(400)) - {7}:
        got = [of[n] for n in range(e, 8000, 400)]
        assert all(abs(got.count(name) - 20 * share) < len(splits.QUOTAS) for name, share in splits.QUOTAS), (e, got)


def test_ranks_are_the_same_for_any_number_of_salts(spark):
    df = spark.range(300).select((F.col("id") % 2).alias("g"), (F.col("id") % 7).alias("r"), F.col("id"))
    ranks = [{r["id"]: (r["g"], r["r"], r["rank"]) for r in splits.ranked(df, ["g"], ["id"], salts, ("r",)).collect()} for salts in (1, 5, 90)]
    assert ranks[0] == ranks[1] == ranks[2]
    for g in range(2):
        runs = [r for _, r in sorted((rank, r) for h, r, rank in ranks[0].values() if h == g)]
        assert len(runs) == 150 and sum(a != b for a, b in zip(runs, runs[1:])) == 6
