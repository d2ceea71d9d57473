"""Files that grow: what is read per run, what a replaced or cut file does, and that a batch is the same bytes again."""

import json
import os
import random

import pytest

from meterloom.sources import growing
from meterloom.sources.growing import GrowingLinesReader, bytes_read, growing_lines


def reader(root, ledger, split=growing.SPLIT):
    return GrowingLinesReader({"path": str(root), "ledger": str(ledger), "split": str(split)})


def lines(r, start, end):
    """(path, epoch, place, value) of a batch."""
    out = []
    for part in r.partitions(start, end):
        for batch in r.read(part):
            out += list(zip(*(batch.column(c).to_pylist() for c in ("path", "epoch", "line", "value"))))
    return sorted((os.path.basename(p), e, at, v) for p, e, at, v in out)


@pytest.mark.parametrize("split", [1, 7, 50, 1 << 20])
def test_pieces_hold_each_line_once(tmp_path, split):
    rng, wanted = random.Random(split), []
    for n in range(5):
        at, text = 0, b""
        for _ in range(rng.randrange(40)):
            value = "é" * rng.randrange(12)
            wanted.append((f"{n}.jsonl", 0, at, value))
            text += value.encode() + (b"\r\n" if rng.random() < 0.3 else b"\n")
            at = len(text)
        (tmp_path / f"{n}.jsonl").write_bytes(text + b"not complete")
    (tmp_path / "other.txt").write_text("x\n")
    r = reader(tmp_path, tmp_path / "ledger", split)
    assert lines(r, r.initialOffset(), r.latestOffset()) == sorted(wanted)


def test_appended_replaced_and_cut(tmp_path):
    root, ledger = tmp_path / "logs", tmp_path / "ledger"
    (root / "deep").mkdir(parents=True)
    a, b, c = root / "a.jsonl", root / "deep" / "b.jsonl", root / "c.jsonl"
    r = lambda: reader(root, ledger, 64)  # each run is a new process
    a.write_text("a1\na2\na3 is not comp")
    b.write_text("b1\n")
    c.write_text("c1\nc2\nc3\n")
    one = r().latestOffset()
    assert lines(r(), {"version": 0}, one) == [("a.jsonl", 0, 0, "a1"), ("a.jsonl", 0, 3, "a2"), ("b.jsonl", 0, 0, "b1"),
                                                ("c.jsonl", 0, 0, "c1"), ("c.jsonl", 0, 3, "c2"), ("c.jsonl", 0, 6, "c3")]
    assert r().latestOffset() == one                                   # nothing new
    with a.open("a") as f:
        f.write("lete\n")
    (root / "b.new").write_text("B1 is longer than b1\n")
    (root / "b.new").rename(b)                                        # another file
    c.write_text("C1\n")                                              # the same file, shorter
    two = r().latestOffset()
    second = [("a.jsonl", 0, 6, "a3 is not complete"), ("b.jsonl", 1, 0, "B1 is longer than b1"), ("c.jsonl", 1, 0, "C1")]
    assert lines(r(), one, two) == lines(r(), one, two) == second     # a batch that runs again
    c.write_text("D1\nD2 this is longer\n")                           # the same file, longer, other first bytes
    os.remove(a)
    three = r().latestOffset()
    assert lines(r(), two, three) == [("c.jsonl", 2, 0, "D1"), ("c.jsonl", 2, 3, "D2 this is longer")]
    assert lines(r(), one, three) == [x for x in second if x[0] == "b.jsonl"] + lines(r(), two, three)  # what is gone is not read
    state = {os.path.basename(f["path"]): f for f in growing.Ledger(str(ledger)).read(three["version"])}
    assert set(state) == {"b.jsonl", "c.jsonl"} and state["b.jsonl"]["start"] == state["b.jsonl"]["stop"]


def test_reads_only_what_is_new(spark, tmp_path):
    root, ledger, out, progress = (str(tmp_path / n) for n in ("logs", "ledger", "out", "progress"))
    os.makedirs(root)

    def run():
        stream = growing_lines(spark, root, ledger, split=200)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.value for r in spark.read.parquet(out).collect()), key=lambda v: json.loads(v))

    told, sizes = [], []
    for n in range(3):
        size = 0
        for i in range(6):
            with open(f"{root}/{i}.jsonl", "a") as f:
                for j in range(20 + i):
                    told.append(json.dumps([n, i, j]))
                    size += f.write(told[-1] + "\n")
        sizes.append(size)
        assert run() == sorted(told, key=json.loads)
    assert run() == sorted(told, key=json.loads)
    got = [tuple(r) for r in bytes_read(spark, ledger).orderBy("version").collect()]
    assert got == [(n + 1, 6, sizes[n], sum(sizes[:n + 1])) for n in range(3)]


def test_small_files_share_a_batch_and_a_changed_file_is_opened_once(tmp_path, monkeypatch):
    for n in range(40):
        (tmp_path / f"{n:02}.jsonl").write_bytes(b"a\xff%d\n\r\nlast" % n)
    r, opened, real = reader(tmp_path, tmp_path / "ledger"), [], os.open
    monkeypatch.setattr(growing.os, "open", lambda path, *more: opened.append(path) or real(path, *more))
    monkeypatch.setattr(growing, "open", lambda path, *more: opened.append(path) or open(path, *more), raising=False)
    end = r.latestOffset()
    assert sorted(p for p in opened if p.endswith(".jsonl") and "ledger" not in p) == [f"{tmp_path}/{n:02}.jsonl" for n in range(40)]
    parts = r.partitions(r.initialOffset(), end)
    batches = [b for p in parts for b in r.read(p)]
    assert len(parts) == 1 and [b.num_rows for b in batches] == [80]
    assert batches[0].column("value").to_pylist()[:3] == ["a�0", "", "a�1"] and batches[0].column("line").to_pylist()[:3] == [0, 4, 0]


@pytest.mark.parametrize("read", [1, 5, 64])
def test_lines_longer_than_a_read_stay_whole(tmp_path, monkeypatch, read):
    wanted = ["x" * n for n in (0, 1, 90, 3, 200, 0)]
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "a.jsonl").write_text("".join(v + "\n" for v in wanted))
    monkeypatch.setattr(growing, "READ", read)
    for split in (8, 1 << 20):
        r = reader(tmp_path / "logs", tmp_path / f"ledger-{split}", split)
        assert [v for _, _, _, v in lines(r, r.initialOffset(), r.latestOffset())] == wanted
