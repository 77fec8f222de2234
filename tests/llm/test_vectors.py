import numpy as np
import pytest

from tessera.llm.ann import hilbert_keys, nearest
from tessera.llm.components import connected_components
from tessera.llm.embed_dedup import least_collisions, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, h string, copies int"


def clustered(seed, n=260, dim=64):
    rng = np.random.default_rng(seed)
    rows, base = [], rng.standard_normal((12, dim))
    for i in range(n):
        v = base[i % 12] + rng.standard_normal(dim) * rng.choice([0.05, 0.25, 0.35, 3.0]) if i % 3 else rng.standard_normal(dim)
        rows.append((i * 5, [float(x) for x in np.float32(v * rng.uniform(0.2, 4))], int(i % 3), "x", 1))
    rows += [(5000 + k, rows[1][1], rows[1][2], "x", 1) for k in range(40)]  # a hot vector
    return rows


BAD = [
    (9001, None, 1, "x", 1), (9002, [0.0] * 64, 1, "x", 1), (9003, [float("nan")] + [1.0] * 63, 1, "x", 1), (9004, [None] + [1.0] * 63, 1, "x", 1),
    (9005, [float("inf")] + [1.0] * 63, 1, "x", 1), (9006, [], 1, "x", 1), (9007, [1.0, 2.0], 1, "x", 1),
]


def brute_links(rows, threshold):
    ok = [r for r in rows if r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links, up = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(ok)):
        for b in range(a):
            x, y = np.array(ok[a][1], float), np.array(ok[b][1], float)
            if ok[a][2] == ok[b][2] and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[ok[a][0]] += 1
                links[ok[b][0]] += 1
                p, q = root(ok[a][0]), root(ok[b][0])
                up[max(p, q)] = min(p, q)
    return sorted((i, links[i], root(i), root(i) == i) for i in links)


@pytest.mark.parametrize("block", [4096, 40])
def test_links_equal_brute_force(spark, block):
    rows = clustered(3) + BAD + [(9100, [1.0] * 64, None, "x", 1), (9101, [1.0] * 64, None, "x", 1)]
    got = sorted(tuple(r) for r in near_vectors(spark.createDataFrame(rows, SCHEMA), block=block).collect())
    assert got == brute_links(rows, 0.93)


def test_no_rows_and_null_ids(spark):
    df = spark.createDataFrame([(None, [1.0] * 64, 1, "x", 1), (7, [1.0] * 64, 1, "x", 1)], SCHEMA)
    assert sorted(map(str, (tuple(r) for r in near_vectors(df).collect()))) == sorted(map(str, [(None, 0, None, False), (7, 0, 7, True)]))
    assert near_vectors(df.limit(0)).count() == 0
    assert least_collisions(24, 2.0, 1e-7) >= 12


def test_repeated_ids_are_vectors_of_their_own(spark):
    rng = np.random.default_rng(9)
    a, b = (rng.standard_normal(64) for _ in range(2))
    near = lambda v: [float(x) for x in np.float32(v + 0.02 * rng.standard_normal(64))]
    rows = [(5, near(a), 1, "x", 1), (5, near(b), 1, "x", 1), (7, near(b), 1, "x", 1), (6, near(a), 1, "x", 1), (3, near(a), 1, "x", 1)]
    got = sorted(tuple(r) for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == sorted([(5, 2, 3, False), (5, 1, 5, True), (7, 1, 5, False), (6, 2, 3, False), (3, 2, 3, True)])


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 400)] + [(5, 5), (None, 3), (399, 398), (2, 100), (2, 100)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[i] for i in range(100, 161)} == {2} and got[2] == 2
    assert {got[i] for i in range(300, 400)} == {7} and got[7] == 7
    assert 5 not in got and len(got) == 62 + 101


def test_hilbert_is_a_curve():
    side = 8
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = hilbert_keys(cells, bits=3)
    assert sorted(keys) == list(range(side**3))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def brute_nearest(rows, k):
    ok = [r for r in rows if r[1] and len(r[1]) == 64 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    x, ids = np.array([r[1] for r in ok]), np.array([r[0] for r in ok])
    out = {}
    for i in np.nonzero(ids % 20 == 0)[0]:
        s = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def check(rows, got, k, least):
    want, hits, total = brute_nearest(rows, k), 0, 0
    by = {}
    for q, rank, v, s in got:
        by.setdefault(q, []).append((rank, v, s))
    assert set(by) == set(want)
    vec = {r[0]: np.array(r[1], float) for r in rows if r[1] and len(r[1]) == 64 and None not in r[1]}
    for q, own in by.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, len(own) + 1)) and len(own) == len(want[q])
        assert [(-s, v) for _, v, s in own] == sorted((-s, v) for _, v, s in own)
        assert all(abs(s - vec[q] @ vec[v]) < 1e-9 and v != q for _, v, s in own)
        hits += len({v for _, v, _ in own} & {v for v, _ in want[q]})
        total += len(want[q])
    assert hits / total >= least


def test_recall_against_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    got = [tuple(r) for r in nearest(df, df.filter("vec_id % 20 = 0"), block=64).collect()]
    check(rows, got, 20, 0.9)


def test_clustered_lengths_ties_and_bad_rows(spark):
    rows = clustered(8) + BAD
    df = spark.createDataFrame(rows, SCHEMA)
    check(rows, [tuple(r) for r in nearest(df, df.filter("vec_id % 20 = 0"), block=50).collect()], 20, 0.9)
    few = df.filter("vec_id < 30")
    check([r for r in rows if r[0] < 30], [tuple(r) for r in nearest(few, few.filter("vec_id % 20 = 0")).collect()], 20, 1.0)
    assert nearest(df.limit(0), df.limit(0)).count() == 0
