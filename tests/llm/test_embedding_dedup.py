import math

import numpy as np
import pytest
from compare import connect, differences

from sheetloom.llm.embedding_dedup import BLOCK, bucket_keys, near_duplicates
from sheetloom.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """vec_id -> (n_links, component) for rows with unique ids."""
    def usable(v, label):
        return (label is not None and v and all(x is not None and math.isfinite(x) for x in v)
                and any(v))
    good = [(i, np.array(v, dtype=np.float32).astype(float), la) for i, v, la in rows if usable(v, la)]
    links = {i: set() for i, _, _ in rows}
    for i, a, la in good:
        for j, b, lb in good:
            if i != j and la == lb and len(a) == len(b):
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                    links[i].add(j)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen))
    return out


def random_rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            base = np.array(rows[rng.integers(len(rows))][1])
            v = base + rng.normal(0, rng.choice([0, 0.05, 0.12]) / math.sqrt(dim), dim) * np.linalg.norm(base)
        else:
            v = rng.standard_normal(dim)
        rows.append((i, [float(x) for x in np.float32(v)], int(rng.integers(2))))
    return rows


def test_links_and_components_equal_brute_force(spark):
    rows = random_rows(500, 32, 1)
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
            (6, [], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1),
            (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, [-1.0, 0.0], 1)]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == brute(rows)


def test_empty_repeated_and_extra_columns(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, [1.0, 0.5], 1, "a", 5), (1, [1.0, 0.5], 1, "b", 6), (2, [0.0, 1.0], 1, "c", 7),
            (None, [1.0, 0.5], 1, "d", 8)]
    df = spark.createDataFrame(rows, SCHEMA + ", id string, n int")
    found = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in near_duplicates(df).collect())
    assert found == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2)]


def test_a_group_beyond_one_block(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(16)
    n = BLOCK + 300
    rows = [(i, [float(x) for x in base + rng.normal(0, 0.02, 16)], 1) for i in range(n)]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    v = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    links = (v @ v.T >= 0.98).sum(axis=1) - 1
    assert {r.vec_id: r.n_links for r in found} == dict(enumerate(links.tolist()))
    assert {r.component_id for r in found} == {0}


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((20_000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    side = rng.standard_normal(a.shape)
    side -= (side * a).sum(axis=1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    b = 0.98 * a + math.sqrt(1 - 0.98 ** 2) * side
    met = (bucket_keys(a) == bucket_keys(b)).any(axis=1).mean()
    assert met >= 0.999


@pytest.mark.parametrize("name", ["op1_embedding_near_dedup", "op4_warc", "op5_chat_formatting"])
def test_queries_against_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    assert differences(spark, connect(sf_dir), QUERIES[name], ORACLE[name], sf_dir) is None
