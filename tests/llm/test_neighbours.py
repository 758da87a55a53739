"""Links and groups against all pairs."""

import numpy as np

from smeltery.llm import neighbours
from smeltery.llm.queries import QUERIES


def brute(rows, threshold=0.98):
    """n_links, component and kept of each row by all pairs in double precision."""
    good = {}
    for i, (vec_id, vector, label) in enumerate(rows):
        if vec_id is None or label is None or not vector or any(x is None or not np.isfinite(x) for x in vector):
            continue
        v = np.array(vector, float)
        if v.any():
            v = v / np.abs(v).max()
            good[i] = v / np.linalg.norm(v)
    links, name = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    spaces = {}
    for i, v in good.items():
        spaces.setdefault((rows[i][2], len(v)), []).append(i)
    for own in spaces.values():
        sims = np.array([good[i] for i in own]) @ np.array([good[i] for i in own]).T
        for a, b in np.argwhere(sims >= threshold):
            if a != b:
                links[own[a]] += 1
                name[root(own[a])] = root(own[b])
    least = {}
    for i, r in enumerate(rows):
        k = root(i)
        least[k] = min([x for x in (least.get(k), r[0]) if x is not None], default=None)
    return sorted(
        ((r[0], links[i], least[root(i)], r[0] is not None and least[root(i)] == r[0]) for i, r in enumerate(rows)), key=str
    )


def near(rng, center, n, spread):
    return [(center + rng.normal(size=len(center)) * spread).tolist() for _ in range(n)]


def test_query_equals_brute_force(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = [tuple(r) for r in QUERIES["op4_embedding_groups"](spark, small).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_crowds_copies_and_pairs(spark):
    rng = np.random.default_rng(9)
    vectors = [rng.normal(size=24).tolist() for _ in range(900)]
    vectors += near(rng, rng.normal(size=24), 700, 0.06)  # a crowd, saturated lists
    for _ in range(60):
        vectors += near(rng, rng.normal(size=24), 2, 0.08)
    vectors += [vectors[3]] * 50 + [(np.array(vectors[4]) * 7).tolist()]
    rows = [(i * 3 % 100_003, v, int(i % 2 if i < 900 else 1)) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted((tuple(r) for r in neighbours.near_duplicates(frame).collect()), key=str)
    want = brute(rows)
    assert len(got) == len(want)
    found, true = sum(g[1] for g in got), sum(w[1] for w in want)
    assert found <= true and found >= 0.98 * true
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 2.0], [1.0, 2.0], [2.0, 4.0], None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1e300, 2e300], [1e-300, 2e-300], [1.0, 2.0, 0.0]]
    rows = [(i, v, 1) for i, v in enumerate(vectors)] + [(50, [1.0, 2.0], None), (51, [1.0, 2.0], 2), (None, [1.0, 2.0], 1), (0, [5.0, -1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "1 as node", "2 as component")
    got = sorted((tuple(r) for r in neighbours.near_duplicates(frame).collect()), key=str)
    assert got == brute(rows)
    assert neighbours.near_duplicates(frame.limit(0)).count() == 0
    alone = neighbours.near_duplicates(frame.where("vec_id = 5"))
    assert [tuple(r) for r in alone.collect()] == [(5, 0, 5, True)]


def test_rare_pairs_around_a_common_mean(spark):
    rng = np.random.default_rng(21)
    mean = rng.normal(size=32) * 1.5
    vectors = [(mean + rng.normal(size=32)).tolist() for _ in range(3000)]
    vectors += [(np.array(v) + rng.normal(size=32) * 0.1).tolist() for v in vectors[:25]]
    rows = [(i * 7 % 100_003, v, 1) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted((tuple(r) for r in neighbours.near_duplicates(frame).collect()), key=str)
    assert got == brute(rows) and sum(r[1] for r in got) >= 50
