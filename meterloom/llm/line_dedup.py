"""Line dedup by winnowing over line hashes.

A line is what stands between line feeds; its hash is that of its words (A-Z lower-cased), so spacing does not tell lines
apart. Lines without words belong to no run and are kept. A stretch is consecutive lines with words (those without are
passed over) that hold `words` words or more together, or a whole document of fewer words. A line is deleted if it lies in
a stretch that stood at an earlier place; places are ordered by doc_id (null first), a hash of the text, and line. The
first place keeps its lines, and every deleted line stands undeleted at some earlier place. So no passage of `words` words
in whole lines stays a second time, however it is cut into lines, and a short line that repeats among others stays.

A window is the shortest stretch from a line on, or up to a line. The line with the smallest hash of each window, the first
of equal ones, is a fingerprint: every stretch holds a window, hence one at the same line wherever it stands. Fingerprints
whose line is one nowhere else end here, and their windows with them. The windows of the others are joined to the earliest
place of a window of the same lines (two 64-bit hashes: of the fingerprint's line and of all lines). Where a stretch
repeats, so do the windows from each of its lines on and up to each of its lines, as far as they fit in it: matches thus
extend to both sides up to the first line that differs, and those that share lines are one run. All lines of a repeated
stretch lie in such windows: what follows a line or what precedes it, itself included, holds a window, or else the one from
the stretch's first line on reaches beyond that line.

A window joins its earliest place alone, folded by partial sums, so a passage that a third of all documents share makes as
many rows as it has places and no pairs; the places of one fingerprint or window are dealt over SALTS tasks.

Null and empty texts have no lines (n_lines 0) and stay as they are. Rows that share a doc_id and a text are one document:
each of them is returned with the same lines deleted. A very long text is one array of windows in the task that reads it, in
memory proportional to the text. An empty table gives an empty one. Only doc_id and text are read; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterloom.llm import textkit
from meterloom.session import settle

WORDS = 50
SALTS = 16


def _line_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, number and words of every line with words, in order, and each text's first one."""
    parsed = textkit.words(texts)
    data, offsets = textkit.bytes_of(texts)
    feeds = np.flatnonzero(data == 10)
    line_of = np.searchsorted(feeds, parsed.starts) - np.searchsorted(feeds, offsets[:-1])[parsed.row_of()]
    row = parsed.row_of()
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (line_of[1:] != line_of[:-1])
    first = np.flatnonzero(new)
    hashes = parsed.hashes()
    sizes = np.diff(np.append(first, len(row)))
    place = (np.arange(len(row)) - np.repeat(first, sizes) + 1).astype(np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(textkit.mix(hashes ^ textkit.mix(place)), dtype=np.uint64)])
    own = textkit.mix(sums[np.append(first, len(row))[1:]] - sums[first]) if len(first) else np.zeros(0, np.uint64)
    return own, line_of[first], sizes, np.searchsorted(row[first], np.arange(len(parsed.rows)))


def _windows(sizes: np.ndarray, rows: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """First line and line after the last of every window, each once."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    lines = np.arange(len(sizes))
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    begin, end = rows[:-1][row], rows[1:][row]
    stop = np.searchsorted(sums, sums[:-1] + words)
    first = np.searchsorted(sums, sums[1:] - words, side="right") - 1
    onwards, upto = stop <= end, first >= begin
    small = np.flatnonzero((np.diff(rows) > 0) & (np.diff(sums[rows]) < words))
    ranges = np.concatenate([np.stack([lines[onwards], stop[onwards]], 1), np.stack([first[upto], lines[upto] + 1], 1),
                             np.stack([rows[:-1][small], rows[1:][small]], 1)])
    ranges = np.unique(ranges, axis=0)
    return ranges[:, 0], ranges[:, 1]


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Each fingerprint: its line's hash, the document, and the windows it stands for (hash, first line, last line)."""
    for part in textkit.cuts(batches):
        hashes, _, sizes, rows = _line_hashes(part.column("text"))
        first, stop = _windows(sizes, rows, words)
        at = textkit.least(hashes, first, stop)
        order = np.argsort(at, kind="stable")
        first, stop, at = first[order], stop[order], at[order]
        places, starts = np.unique(at, return_index=True)
        row = np.searchsorted(rows, places, side="right") - 1
        base = rows[np.searchsorted(rows, first, side="right") - 1]
        offsets = pa.array(np.append(starts, len(at)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (
            textkit.ids(textkit.stretches(hashes, first, stop)), (first - base).astype(np.int32), (stop - base - 1).astype(np.int32))]
        yield pa.RecordBatch.from_arrays([pa.array(textkit.ids(hashes[places])), *(part.column(c).take(pa.array(row)) for c in ("doc_id", "x")), *lists],
                                         ["p", "doc_id", "x", "w", "lo", "hi"])


def _dealt(many: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """`many` joined to `few`, one row per key, the rows of a key spread by document over SALTS tasks."""
    salted = many.withColumn("salt", F.pmod(F.hash("doc_id", "x"), F.lit(SALTS)))
    return salted.join(few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*keys, "salt"]).drop("salt")


def fingerprints(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """(p, doc_id, x, w, lo, hi): every fingerprint's line hash, document, and windows. x: hash of the text."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _fingerprints(batches, words)

    texts = _keyed(documents).select("doc_id", "x", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(found, "p long, doc_id long, x long, w array<long>, lo array<int>, hi array<int>")


def repeats(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, x, runs): the windows (lo, hi: lines, numbered among those with words) of a document that stood earlier."""
    prints = settle(fingerprints(documents, words), "fingerprints")
    again = prints.groupBy("p").agg(F.count("*").alias("n")).where("n > 1").select("p")
    windows = settle(_dealt(prints, again, ["p"]).select("p", "doc_id", "x", F.explode(F.arrays_zip("w", "lo", "hi")).alias("v")).select(
        "p", "v.w", "doc_id", "x", "v.lo", "v.hi"), "windows")
    place = F.struct("doc_id", "x", "lo")
    earliest = windows.groupBy("p", "w").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("p", "w", "first")
    later = _dealt(windows, earliest, ["p", "w"]).where(place > F.col("first"))
    return later.groupBy("doc_id", "x").agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.withColumns({"doc_id": F.col("doc_id").cast("long"), "x": F.xxhash64("text")})


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in textkit.cuts(batches):
        _, number, _, rows = _line_hashes(part.column("text").cast(pa.binary()))
        texts, totals, gone = [], [], []
        for i, (text, runs) in enumerate(zip(part.column("text").to_pylist(), part.column("runs").to_pylist())):
            own = number[rows[i]:rows[i + 1]]
            within = np.zeros(len(own) + 1, np.int64)  # running sum: how many runs each line lies in
            np.add.at(within, [r["lo"] for r in runs or ()], 1)
            np.add.at(within, [r["hi"] + 1 for r in runs or ()], -1)
            lines = np.flatnonzero(np.cumsum(within))
            totals.append(len(own))
            gone.append(len(lines))
            if len(lines):
                bad = set(own[lines].tolist())
                text = "\n".join(x for j, x in enumerate(text.split("\n")) if j not in bad)
            texts.append(text)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string()), pa.array(totals, pa.int32()), pa.array(gone, pa.int32())],
                                         ["doc_id", "text", "n_lines", "n_removed"])


def clean(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, text without the runs that repeat, n_lines (with words) and n_removed, for every row of documents."""
    own = _keyed(documents.select("doc_id", "text")).alias("d")
    gone = repeats(documents, words).select(F.col("doc_id").alias("_id"), F.col("x").alias("_x"), "runs").alias("g")
    return own.join(gone, F.col("d.doc_id").eqNullSafe(F.col("_id")) & (F.col("x") == F.col("_x")), "left").select(
        "doc_id", "text", "runs").mapInArrow(_rewritten, "doc_id long, text string, n_lines int, n_removed int")
