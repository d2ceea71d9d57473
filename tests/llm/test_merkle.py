"""The manifest beside a plain tree, its witnesses folded by hand, and what happens to a changed row."""

import hashlib
import random
import zlib

from fixtures import awkward, documents
from meterloom.llm import merkle
from meterloom.llm.queries import QUERIES

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return H(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def tree(digests):
    """(root, per leaf the siblings before and after, level by level)."""
    steps, nodes = [[] for _ in digests], [(d, [i]) for i, d in enumerate(digests)]
    while len(nodes) > 1:
        new = []
        for at in range(0, len(nodes), 16):
            run = nodes[at:at + 16]
            for i, (_, below) in enumerate(run):
                for leaf_ in below:
                    steps[leaf_].append(("".join(d for d, _ in run[:i]), "".join(d for d, _ in run[i + 1:])))
            new.append((H(*[d for d, _ in run]), [x for _, below in run for x in below]))
        nodes = new
    return nodes[0][0], steps


def expected(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    if not rows:
        return []
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        by[name].sort(key=lambda x: x[:3])
        trees[name] = tree([x[2] for x in by[name]])
    root, upper = tree([trees[n][0] for n in names])
    out = []
    for n, name in enumerate(names):
        for i, (_, _, digest, row) in enumerate(by[name]):
            steps = trees[name][1][i] + upper[n]
            text = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and text is not None:
                text = text.encode().translate(bytes(x + 32 if 65 <= x < 91 else x for x in range(256))).decode()
            folded = leaf(*row[:4], text)
            for before, after in steps:
                folded = H(before, folded, after)
            out.append((row[0], digest, trees[name][0], root, H(*[x for s in steps for x in s]), folded, folded == root))
    return out


def rows(n, seed=1):
    rng = random.Random(seed)
    made = [(i, f"Text {i} " * rng.randrange(4), rng.choice(["big"] * 8 + ["s%d" % (i % 40), None, "", "é", "\U0001F600", "ｚ"])) for i in range(n)]
    return awkward() + made + made[:3] + [(5, None, "alone")]


def check(spark, given, folder):
    docs = documents(spark, given)
    docs.write.parquet(folder)
    got = [tuple(r) for r in QUERIES["op11_merkle_manifest"](spark, folder.rsplit("/", 1)[0]).collect()]
    plain = expected([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()])
    assert sorted(got, key=repr) == sorted(plain, key=repr)
    return got


def test_query_equals_brute_force(spark, tmp_path):
    got = check(spark, rows(1500), str(tmp_path / "documents.parquet"))
    assert {r[6] for r in got} == {True, False}


def test_small_and_empty_tables(spark, tmp_path):
    for n, given in enumerate([[], [(1, "a", "s")], [(1, "a", "s"), (2, "B", "t")], [(None, None, None)] * 2, [(i, "x", "s") for i in range(257)]]):
        (tmp_path / str(n)).mkdir()
        check(spark, given, str(tmp_path / str(n) / "documents.parquet"))


def test_manifest_proves_each_row(spark):
    docs = documents(spark, rows(300))
    for r in merkle.manifest(docs).collect():
        digest = r.leaf
        for before, after in zip(r.steps[::2], r.steps[1::2]):
            digest = H(before, digest, after)
        assert digest == r.root


def test_append_keeps_earlier_witnesses():
    """A witness only grows: what a node knew when its subtree closed stays."""
    rng, block = random.Random(2), merkle.Append()
    nodes, known = [], []
    for _ in range(200):
        nodes.append(block.add(H(str(rng.random())).encode()))
        now = [n.witness() for n in nodes]
        assert all(after[:len(before)] == before for before, after in zip(known, now))
        known = now
    root = block.close(merkle.height(200))
    assert all(merkle.fold(n.digest, n.witness()) == root.digest for n in nodes)
