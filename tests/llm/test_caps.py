"""Spherical-cap filters beside all pairs: planted groups, recall at the edge, skew and awkward vectors."""

import numpy as np
import pytest

from meterloom.llm import caps
from meterloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, node long, sort string, n int, key string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, "s", 2, "k") for i, v, lab in rows], SCHEMA)


def brute(rows, cosine=0.93):
    """Per row (vec_id, n_links, component_id, kept)."""
    ok = [v is not None and lab is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    unit = [np.array(v, float) / np.abs(np.array(v, float)).max() if o else None for (_, v, _), o in zip(rows, ok)]
    near = [[j for j, (_, w, lw) in enumerate(rows) if j != i and ok[i] and ok[j] and rows[i][2] == lw and len(rows[i][1]) == len(w)
             and unit[i] @ unit[j] / (np.linalg.norm(unit[i]) * np.linalg.norm(unit[j])) >= cosine] for i in range(len(rows))]
    component = {}
    for i in range(len(rows)):
        if i not in component:
            seen, todo = {i}, [i]
            while todo:
                for j in near[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            ids = [rows[j][0] for j in seen if rows[j][0] is not None]
            for j in seen:
                component[j] = min(ids) if ids else None
    return [(r[0], len(near[i]), component[i], r[0] is not None and r[0] == component[i]) for i, r in enumerate(rows)]


def vectors(seed, groups=30, size=12, dim=64, noise=0.004):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        centre = rng.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        for _ in range(int(rng.integers(1, size))):
            out.append((centre + noise * rng.standard_normal(dim)).astype(np.float32).tolist())
    return out


def got(spark, rows, tmp_path):
    table(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    return sorted((tuple(r) for r in QUERIES["op12_embedding_near_dedup"](spark, str(tmp_path)).collect()), key=repr)


def test_query_equals_brute_force(spark, tmp_path):
    found = vectors(1)
    rows = [(10 * i, v, i % 2) for i, v in enumerate(found)] + [(10 * i + 5, v, i % 2) for i, v in enumerate(found[:40])]
    nan, inf = float("nan"), float("inf")
    rows += [(1, None, 0), (2, [], 0), (3, [0.0] * 64, 0), (4, [nan] + [1.0] * 63, 0), (6, [1.0, inf] * 32, 0), (7, [None] + [1.0] * 63, 0),
             (8, found[0], None), (9, found[0], 7), (None, found[0], 0), (None, found[1], 0), (20, found[5], 0), (20, found[5], 0),
             (11, [3.0, 4.0], 0), (12, [6.0, 8.0], 0), (13, [1.0], 0), (14, [-2.0], 0), (15, [5.0], 0), (16, [1e38] * 64, 0), (17, [1e-38] * 64, 0)]
    assert got(spark, rows, tmp_path) == sorted(brute(rows), key=repr)


def test_crowded_filters_are_cut_into_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(caps, "TILE", 40)
    monkeypatch.setattr(caps, "SMALL", 8)
    found = vectors(2, groups=3, size=200, noise=0.005)
    rows = [(i, v, 0) for i, v in enumerate(found)]
    assert got(spark, rows, tmp_path) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("dim", [8, 64])
def test_recall_at_the_edge(spark, tmp_path, dim):
    """Pairs whose cosine is just the least one: 0.9 and more must be found; nearer ones are found more often."""
    rng, rows = np.random.default_rng(5), []
    for i in range(600):
        a = rng.standard_normal(dim)
        a /= np.linalg.norm(a)
        o = rng.standard_normal(dim)
        o -= (o @ a) * a
        o /= np.linalg.norm(o)
        cosine = 0.9301 if i < 300 else 0.96
        rows += [(2 * i, a.astype(np.float32).tolist(), i), (2 * i + 1, (cosine * a + (1 - cosine ** 2) ** 0.5 * o).astype(np.float32).tolist(), i)]
    linked = {r[0] for r in got(spark, rows, tmp_path) if r[1]}
    edge, near = (sum(2 * i in linked for i in part) / 300 for part in (range(300), range(300, 600)))
    assert edge >= 0.97 and near >= 0.995


def test_empty_table(spark, tmp_path):
    assert got(spark, [], tmp_path) == []
