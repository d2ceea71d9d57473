"""Files that grow: a stream of the complete lines that were appended since the last batch.

`latestOffset` lists the tree and compares each file with what the ledger holds of it: its inode, how far it was read, and
a digest of its first bytes. More bytes are a range to read, up to the last line feed; another inode, other first bytes
or fewer bytes than were read are a new file in the old one's place, read from its start in a new epoch. The new state of
all files is one ledger version, written beside the stream's checkpoint, and the offset is its number; so an offset is
small however many files there are, and a batch that runs again after a crash reads the very same bytes. Ranges are cut
into pieces of SPLIT bytes and packed into partitions of about as many, so that neither a large file nor many small
ones make the plan.

The folder is one that the driver and every executor mount, as for any log shipper; other stores have no inodes."""

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SPLIT = 32 << 20
HEAD = 256
ROWS = 8192
#: Bytes of a file read at once.
READ = 1 << 20
#: `block` is where the piece starts in its file, `line` where the line does.
LINES = "value STRING, path STRING, epoch LONG, block LONG, line LONG"
RANGES = "version LONG, path STRING, inode LONG, epoch LONG, head STRING, head_bytes LONG, changed LONG, start LONG, stop LONG"


def local_path(path: str) -> str:
    """A mounted folder's path, of a plain path or a file: URI."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if not path.startswith("/"):
        raise ValueError(f"not a mounted folder: {path!r}")
    return path


def last_line_end(fd: int, start: int, size: int) -> int:
    """The byte after the last line feed in [start, size), or start; read backwards from the end."""
    end = size
    while end > start:
        begin = max(start, end - 65536)
        at = os.pread(fd, end - begin, begin).rfind(b"\n")
        if at >= 0:
            return begin + at + 1
        end = begin
    return start


def head_digest(head: bytes, n: int) -> str:
    return hashlib.sha1(head[:n]).hexdigest()


def next_state(path: str, held: dict | None) -> dict | None:
    """What the ledger says of a file now; None when it is gone. A changed file is opened once."""
    try:
        stat = os.stat(path)
        if held and (stat.st_ino, stat.st_mtime_ns, stat.st_size) == (held["inode"], held["changed"], held["size"]):
            return held | {"start": held["stop"]}
        fd = os.open(path, os.O_RDONLY)
    except FileNotFoundError:
        return None
    try:
        stat, head = os.fstat(fd), os.pread(fd, HEAD, 0)
        again = held is not None and (stat.st_ino != held["inode"] or stat.st_size < held["stop"]
                                      or head_digest(head, held["head_bytes"]) != held["head"])
        start = 0 if held is None or again else held["stop"]
        stop = last_line_end(fd, start, stat.st_size)
        head_bytes = min(HEAD, stop)
        return {"path": path, "inode": stat.st_ino, "epoch": (held["epoch"] + again) if held else 0, "changed": stat.st_mtime_ns,
                "size": stat.st_size, "head_bytes": head_bytes, "head": head_digest(head, head_bytes), "start": start, "stop": stop}
    finally:
        os.close(fd)


class Ledger:
    """One file of JSON lines per version, each the state of every file; written whole, then renamed into place."""

    def __init__(self, folder: str):
        self.folder = local_path(folder)
        os.makedirs(self.folder, exist_ok=True)

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".jsonl")) for n in os.listdir(self.folder) if n.endswith(".jsonl"))

    def read(self, version: int) -> list[dict]:
        if version == 0:
            return []
        with open(f"{self.folder}/{version}.jsonl") as f:
            return [json.loads(line) for line in f]

    def write(self, version: int, files: list[dict]) -> None:
        made = f"{self.folder}/.{version}.{os.getpid()}"
        with open(made, "w") as f:
            f.writelines(json.dumps({"version": version} | file) + "\n" for file in files)
        os.replace(made, f"{self.folder}/{version}.jsonl")


@dataclass
class Pieces(InputPartition):
    """Parts of files: each the file's state and the bytes in which a line must start to belong to it."""
    pieces: list[tuple[dict, int, int]]


class GrowingLinesReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root, self.suffix = local_path(options["path"]), options.get("suffix", ".jsonl")
        self.split, self.folder = int(options.get("split", SPLIT)), options["ledger"]

    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        ledger = Ledger(self.folder)
        version = (ledger.versions() or [0])[-1]
        held = {f["path"]: f for f in ledger.read(version)}
        files = [self._state(f"{folder}/{name}", held) for folder, _, names in os.walk(self.root) for name in names if name.endswith(self.suffix)]
        files = sorted((f for f in files if f is not None), key=lambda f: f["path"])
        if any(f["stop"] > f["start"] for f in files):
            version += 1
            ledger.write(version, files)
        return {"version": version}

    def _state(self, path: str, held: dict) -> dict | None:
        return next_state(path, held.get(path))

    def partitions(self, start: dict, end: dict) -> list[Pieces]:
        ledger, packed, room = Ledger(self.folder), [], 0
        for version in range(start["version"] + 1, end["version"] + 1):
            for file in ledger.read(version):
                for a in range(file["start"], file["stop"], self.split):
                    b = min(a + self.split, file["stop"])
                    if room < b - a:
                        packed.append(Pieces([]))
                        room = self.split
                    packed[-1].pieces.append((file, a, b))
                    room -= b - a
        return packed

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        """The lines of many small pieces in one batch, those of a large one in several."""
        made, rows, size = [], 0, 0
        for file, a, b in partition.pieces:
            for lines, places in lines_of(file, a, b):
                made.append((file, a, lines, places))
                rows, size = rows + len(lines), size + places[-1] - places[0]
                if rows >= ROWS or size >= READ:
                    yield batch_of(made)
                    made, rows, size = [], 0, 0
        if made:
            yield batch_of(made)


def lines_of(file: dict, a: int, b: int) -> Iterator[tuple[list[bytes], list[int]]]:
    """The lines that start in [a, b) and their places, a stretch of about READ bytes at a time. A file replaced since it was
    listed has none; its new bytes are listed anew."""
    try:
        f = open(file["path"], "rb")
    except FileNotFoundError:
        return
    with f:
        stat = os.fstat(f.fileno())
        head = hashlib.sha1(f.read(file["head_bytes"])).hexdigest()
        if stat.st_ino != file["inode"] or stat.st_size < file["stop"] or head != file["head"]:
            return
        at = a
        if a > file["start"]:
            f.seek(a - 1)
            at = a - 1 + len(f.readline())
        else:
            f.seek(a)
        while at < b:
            text = f.read(min(READ, b - at))
            if not text:
                return
            if not text.endswith(b"\n"):
                text += f.readline()
            lines = text.removesuffix(b"\n").split(b"\n")
            places = list(accumulate((len(line) + 1 for line in lines[:-1]), initial=at))
            yield [line.removesuffix(b"\r") for line in lines], places
            at += len(text)


def batch_of(made: list[tuple[dict, int, list[bytes], list[int]]]) -> pa.RecordBatch:
    """Lines of several pieces as columns; bytes that are no UTF-8 are replaced."""
    lines = [line for _, _, own, _ in made for line in own]
    values = pa.array([line.decode(errors="replace") for line in lines], pa.string())
    n = [len(own) for _, _, own, _ in made]
    repeated = lambda column: [v for v, times in zip(column, n) for _ in range(times)]
    return pa.RecordBatch.from_arrays([
        values, pa.array(repeated([f["path"] for f, _, _, _ in made]), pa.string()), pa.array(repeated([f["epoch"] for f, _, _, _ in made]), pa.int64()),
        pa.array(repeated([a for _, a, _, _ in made]), pa.int64()), pa.array([p for _, _, _, places in made for p in places], pa.int64())],
        ["value", "path", "epoch", "block", "line"])


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema) -> GrowingLinesReader:
        return GrowingLinesReader(dict(self.options))


def growing_lines(spark: SparkSession, folder: str, ledger: str, suffix: str = ".jsonl", split: int = SPLIT) -> DataFrame:
    """A stream of the lines of LINES appended under `folder`. A file in another's place is another path to its readers."""
    spark.dataSource.register(GrowingLines)
    made = (spark.readStream.format("growing_lines").option("ledger", ledger).option("suffix", suffix).option("split", split)
            .load(local_path(folder)))
    return made.withColumn("path", F.concat_ws("#", "path", "epoch"))


def bytes_read(spark: SparkSession, ledger: str) -> DataFrame:
    """Per ledger version the files and bytes it read, and the files' bytes in all."""
    held = spark.read.schema(RANGES).json(f"file://{local_path(ledger)}")
    return held.groupBy("version").agg(F.count_if(F.col("stop") > F.col("start")).alias("files_read"),
                                       F.sum(F.col("stop") - F.col("start")).alias("bytes_read"), F.sum("stop").alias("bytes_held"))
