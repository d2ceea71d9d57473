"""Periodic runs beside a plain form that tries every lag and every start."""

import hashlib
import random
import zlib
from fractions import Fraction

import pyarrow as pa
import pytest

from fixtures import awkward, documents
from meterloom.llm import periodic
from meterloom.llm.queries import QUERIES


def brute(words):
    """Every stretch with a period that cannot be extended, its smallest period, if long enough."""
    n, best = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                best.setdefault((i, j + q), q)
                i = j
            i += 1
    return sorted(((a, b - a, q) for (a, b), q in best.items() if b - a >= max(24, 3 * q)), key=lambda r: (r[0], r[2]))


def plant(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digests(doc_id, text):
    words = plant(doc_id, (text or "").encode().split())
    runs = brute(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in drop)))


def texts(seed):
    """Repeats of repeats, runs next to one another, near misses, small vocabularies."""
    rng, out = random.Random(seed), []
    for _ in range(60):
        words = []
        for _ in range(rng.randrange(1, 5)):
            unit = [rng.choice("abcd" if rng.random() < 0.5 else [f"w{i}" for i in range(200)]) for _ in range(rng.randrange(1, 40))]
            if rng.random() < 0.3:
                unit = unit[:3] * 6 + unit
            words += (unit * rng.randrange(1, 7))[:rng.randrange(1, 200)]
            if rng.random() < 0.3:
                words[rng.randrange(len(words))] = "odd"
            words += [f"p{rng.randrange(1000)}" for _ in range(rng.randrange(0, 30))]
        out.append(rng.choice([" ", "\n", "\t "]).join(words))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    given = texts(seed) + ["a " * 23, "a " * 24, "A a " * 12, "", " \x0b ", "x y z " * 8, "x y z " * 7 + "x y", "é à " * 40]
    found = periodic.found_runs(pa.array([t.encode() for t in given], pa.binary()))
    for i, text in enumerate(given):
        assert found.get(i, []) == brute(text.encode().split()) == periodic.lag_by_lag(text.encode().split())


def test_query_equals_brute_force(spark, tmp_path):
    rows = awkward() + [(1000 + i, t, "r") for i, t in enumerate(texts(9))]
    rows = [r for r in rows if r[0] != 50] + [(7, "a b " * 30, "x")]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((digests(d, t) for d, t, _ in rows), key=repr)
    planted = [r for r in got if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0]
    assert planted and sum(r[1] > 0 for r in got) > 20


def test_very_long_text_and_empty_table(spark, tmp_path):
    rng = random.Random(3)
    words = [f"w{rng.randrange(50)}" for _ in range(200_000)]
    words[100_000:] = words[100_000:133_000] * 3 + words[:1_000]
    rows = periodic.runs(documents(spark, [(1, " ".join(words), "a")])).first()
    assert [(r.start, r.period) for r in rows.runs] == [(100_000, 33_000)] and len(rows.collapsed.split()) == 200_000 - rows.runs[0].length + 33_000
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES["op13_periodic_runs"](spark, str(tmp_path)).count() == 0
