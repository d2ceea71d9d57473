"""Runs of repeated word sequences, found by recursive frequency splitting and a lag scan of what is left.

A run is a stretch of consecutive words with smallest period q and at least max(LEAST, COPIES * q) words that no
neighbouring word extends keeping period q. Each of its words thus occurs COPIES times or more in any segment that holds
the run: a word that occurs less often splits the segment, parts under LEAST words go, and the words of the others are
counted anew, until nothing changes. Prose falls to pieces after a few rounds; what survives is scanned for lags.

The lag scan takes the lags of [2^j, 2^(j+1)) together (those below LEAST / 3 * 2 in one). In a run of such a period q
two stretches of W = max(16, 2^(j+1)) words, q apart, are equal, and since W >= q, no nearer one is equal (else q were not
the smallest period). So q is the distance to the next equal window, found by sorting the windows' hashes; consecutive
places with the same distance are the run, exactly. Windows double from one j to the next. That is n log² n for a text of
n words, whatever its lags, with no limit on periods or lengths.

Hashes of words and windows are 64 bits; every run is checked on the words themselves, and should one fail, its document
is scanned again lag by lag. Each document is worked on in the task that reads it; nothing is shuffled. Very long texts
take memory in proportion and are whole. A null, empty or wordless text has no runs and an empty collapsed text; rows
that repeat, also by doc_id, are each their own; an empty table gives an empty one; columns other than those named are
not read."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterloom.llm import textkit
from meterloom.llm.textkit import mix

LEAST = 24
COPIES = 3
_WINDOW = 16
_SALT = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def split(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that may lie in a run, and the segment of each. codes: words; owner: the document of each."""
    at, segment = np.arange(len(codes)), owner
    while len(at):
        _, inverse, counts = np.unique(mix(codes[at] + segment.astype(np.uint64) * _SALT), return_inverse=True, return_counts=True)
        often = counts[inverse] >= COPIES
        kept, of = at[often], segment[often]
        new = np.ones(len(kept), bool)
        new[1:] = (np.diff(kept) != 1) | (of[1:] != of[:-1])
        part = np.cumsum(new) - 1
        long = (np.bincount(part, minlength=1) >= LEAST)[part] if len(kept) else np.zeros(0, bool)
        if len(kept) == len(at) and long.all():
            return at, segment
        at, segment = kept[long], part[long]
    return at, segment


def scan(codes: np.ndarray, segment: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs in segments that lie one after the other, places counted over all."""
    found = []
    place = np.arange(len(codes))
    low, high, w = 1, _WINDOW, _WINDOW
    values = mix(codes + segment.astype(np.uint64) * _SALT)
    hashed = 1
    while len(place):
        edges = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1], [True]]))
        lengths = np.diff(edges)
        large = np.repeat(lengths >= max(LEAST, COPIES * low), lengths)
        if not large.all():
            place, segment, values = place[large], segment[large], values[large]
            continue
        ends = np.repeat(edges[1:], lengths)
        while hashed < w:
            further = np.zeros_like(values)
            further[:len(values) - hashed] = values[hashed:]
            values, hashed = mix(values * np.uint64(0xD6E8FEB86659FD93) + (further ^ _SALT)), hashed * 2
        whole = np.flatnonzero(np.arange(len(values)) + w <= ends)
        order = whole[np.argsort(values[whole], kind="stable")]
        lag = np.zeros(len(values) + 1, np.int64)
        same = values[order[1:]] == values[order[:-1]]
        lag[order[:-1][same]] = np.diff(order)[same]
        lag[(lag < low) | (lag >= high)] = 0
        turns = np.flatnonzero(np.diff(lag, prepend=0))
        for a, b in zip(turns[:-1].tolist(), turns[1:].tolist()):
            q = int(lag[a])
            length = b - 1 - a + w + q
            if q and length >= max(LEAST, COPIES * q):
                found.append((int(place[a]), length, q))
        low, high, w = high, high * 2, high * 2
    return found


def lag_by_lag(words: list[bytes]) -> list[tuple[int, int, int]]:
    """The runs of one document from its words, without hashes."""
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    runs: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // COPIES + 1):
        turns = np.flatnonzero(np.diff(np.concatenate([[0], (codes[q:] == codes[:-q]).astype(np.int8), [0]])))
        for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if b - a + q >= max(LEAST, COPIES * q):
                runs.setdefault((a, b - a + q), q)
    return sorted((start, length, q) for (start, length), q in runs.items())


def found_runs(column: pa.Array) -> dict[int, list[tuple[int, int, int]]]:
    """Runs by row of a binary column, those of a row by start, then period."""
    words = textkit.words(column)
    words.data = textkit.bytes_of(column)[0]
    codes, rows = words.hashes(), words.row_of()
    at, segment = split(codes, rows)
    out: dict[int, list[tuple[int, int, int]]] = {}
    if len(at):
        for start, length, q in scan(codes[at], segment):
            row = int(rows[at[start]])
            out.setdefault(row, []).append((int(at[start] - words.rows[row]), length, q))
    return {row: sorted(runs, key=lambda r: (r[0], r[2])) for row, runs in out.items()}


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words but those that a run holds after its first period."""
    gone = np.zeros(len(words), bool)
    for start, length, q in runs:
        gone[start + q:start + length] = True
    return [words[i] for i in np.flatnonzero(~gone).tolist()]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in textkit.cuts(batches):
        found, texts, runs = found_runs(part.column("text")), [], []
        for row, text in enumerate(part.column("text")):
            words = (text.as_py() or b"").split()
            own = found.get(row, [])
            if any(words[s:s + n - q] != words[s + q:s + n] for s, n, q in own):
                own = lag_by_lag(words)
            texts.append(b" ".join(collapsed(words, own) if own else words))
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
        kind = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(runs, kind), pa.array(texts, pa.binary()).cast(pa.string())],
                                         ["doc_id", "runs", "collapsed"])


def runs(documents: DataFrame) -> DataFrame:
    """Per row doc_id, its runs by start, then period, and its words without the repeats, joined by one space."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(_rows, SCHEMA)
