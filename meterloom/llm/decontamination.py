"""Benchmark decontamination by greedy string tiling.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A document and a benchmark item are compared
when they share a seed, SEED consecutive words (the whole item, if it has fewer). A pair is tiled: the longest matches of
words not yet marked are marked first; none overlaps another and each has SEED words or more. Matches are seeds extended
by running Karp-Rabin hashes in steps of falling powers of two, so two texts of 20,000 words take well under a second
(of 50 distinct words, 0.03 s; of only two, where most seeds match somewhere, 8 s and memory for some millions of matches). The share of the item's words under tiles is its coverage, whatever the tiles' order in the
document, so reordered passages count. COVERAGE or more contaminates the document.

The benchmark goes to the tasks in blocks of at most BLOCK_BYTES of text (an item larger than that is a block of its
own), one pass over the documents per block; the documents are never shuffled.

Null or wordless texts match nothing. Equal items each get their row, equal documents too. A null doc_id or item_id stays
null. Empty tables give empty results. Extra columns are carried by `clean` and ignored by `matches`."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterloom.llm import textkit

SEED = 5
COVERAGE = 0.5
BLOCK_BYTES = 8_000_000
#: Matches that `tiles` looks at before it leaves out those whose words are taken.
PORTION = 8_192
_RADIX = 0x5851F42D4C957F2D
_GAP = np.uint64(0)
MATCHES = "doc_id long, item_id long, n_tiles int, covered_words int, item_words int, coverage double"


def _running(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of tokens times powers, and the inverse powers: together they hash any window (Karp-Rabin)."""
    sums = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(tokens * textkit._power(_RADIX, len(tokens)), out=sums[1:])
    return sums, textkit._power(pow(_RADIX, -1, 1 << 64), len(tokens) + 1)


def _hashed(running: tuple[np.ndarray, np.ndarray], at: np.ndarray, length: int) -> np.ndarray:
    sums, inverse = running
    return (sums[at + length] - sums[at]) * inverse[at]


def _longest(item: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, place in item, place in text) of every match of `least` tokens or more that neither side extends. Seeds of
    both are joined where the tokens before them differ, and each is extended by steps of falling powers of two."""
    a, b = _running(item), _running(text)
    in_item, in_text = np.arange(len(item) - least + 1), np.arange(len(text) - least + 1)
    _, gram = np.unique(np.concatenate([_hashed(a, in_item, least), _hashed(b, in_text, least)]), return_inverse=True)
    known, token = np.unique(np.concatenate([item, text]), return_inverse=True)
    before = np.concatenate([[-1], token[:len(item)]])[:len(in_item)], np.concatenate([[-2], token[len(item):]])[:len(in_text)]
    width = len(known) + 2
    own, theirs = gram[:len(in_item)] * width, gram[len(in_item):] * width + before[1] + 2
    order = np.argsort(theirs, kind="stable")
    theirs = theirs[order]
    # Text places of the same seed, without those that the same token precedes.
    low, high = np.searchsorted(theirs, own), np.searchsorted(theirs, own + width)
    same_low, same_high = (np.searchsorted(theirs, own + before[0] + 2, side) for side in ("left", "right"))
    start, n = np.concatenate([low, same_high]), np.concatenate([same_low - low, high - same_high])
    i = np.repeat(np.concatenate([in_item, in_item]), n)
    j = order[np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())]
    length = np.full(len(i), least)
    for step in 1 << np.arange(int(min(len(item), len(text))).bit_length())[::-1]:
        fits = np.flatnonzero((i + length + step <= len(item)) & (j + length + step <= len(text)))
        equal = _hashed(a, (i + length)[fits], step) == _hashed(b, (j + length)[fits], step)
        length[fits[equal]] += step
    return length, i, j


def tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, place in item, place in text) of each tile. Among equally long matches the first in the item, then in the
    text, is marked first. A match that tiles cut leaves its free parts, which take their turn by their own length."""
    if min(len(item), len(text)) < least:
        return []
    length, i_, j_ = _longest(item, text, least)
    order = np.lexsort((j_, i_, -length))
    done, used, out, parts = np.zeros(len(item), bool), np.zeros(len(text), bool), [], []

    def open_seeds(marked, at, n):
        """Whether `least` words in a row are still free in each match's stretch."""
        free = np.concatenate([[0], np.cumsum(~marked)])
        seeds = np.concatenate([[0], np.cumsum(free[least:] - free[:-least] == least)])
        return seeds[at + n - least + 1] > seeds[at]

    def falling():
        """The matches, longest first, without those that tiles closed meanwhile."""
        for start in range(0, len(order), PORTION):
            part = order[start:start + PORTION]
            part = part[open_seeds(done, i_[part], length[part]) & open_seeds(used, j_[part], length[part])]
            yield from zip((-length[part]).tolist(), i_[part].tolist(), j_[part].tolist())

    whole = falling()
    following = next(whole, None)
    while following or parts:
        if following is None or parts and parts[0] < following:
            n, i, j = heapq.heappop(parts)
        else:
            (n, i, j), following = following, next(whole, None)
        taken = done[i:i - n] | used[j:j - n] | (item[i:i - n] != text[j:j - n])
        if not taken.any():
            done[i:i - n] = used[j:j - n] = True
            out.append((-n, i, j))
            if done.all():
                break
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a >= least:
                heapq.heappush(parts, (a - b, i + a, j + a))
    return out


class Items:
    """A block of benchmark items: their words' hashes, and the sorted hashes of their seeds by seed length."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        parsed = textkit.words(pa.array([text for _, text in rows], pa.binary()), textkit.ALNUM)
        hashes = parsed.hashes()
        self.ids = [i for i, _ in rows]
        self.words = [hashes[a:b] for a, b in zip(parsed.rows[:-1].tolist(), parsed.rows[1:].tolist())]
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in sorted({min(SEED, len(w)) for w in self.words} - {0}):
            own = [(i, textkit.windows(w, np.array([0, len(w)]), k)[0]) for i, w in enumerate(self.words) if min(SEED, len(w)) == k]
            grams = np.concatenate([g for _, g in own])
            items = np.concatenate([np.full(len(g), i) for i, g in own])
            order = np.argsort(grams, kind="stable")
            quick = np.zeros(1 << 20, bool)
            quick[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.seeds[k] = grams[order], items[order], quick

    def matches(self, texts: pa.Array, coverage: float) -> list[tuple[int, int, int, int, float]]:
        """(row, item, tiles, covered words, coverage) of each text and item that share enough."""
        parsed = textkit.words(texts, textkit.ALNUM)
        hashes, counts = parsed.hashes(), np.diff(parsed.rows)
        pairs = set()
        for k, (grams, items, quick) in self.seeds.items():
            found, offsets = textkit.windows(hashes, parsed.rows, k)
            maybe = np.flatnonzero(quick[(found & np.uint64((1 << 20) - 1)).astype(np.int64)])
            low, high = np.searchsorted(grams, found[maybe], "left"), np.searchsorted(grams, found[maybe], "right")
            maybe, low, high = (x[high > low] for x in (maybe, low, high))
            row = np.searchsorted(offsets, maybe, "right") - 1
            for r, a, b in {*zip(row.tolist(), low.tolist(), high.tolist())}:
                if counts[r] >= k:
                    pairs.update((r, int(i)) for i in items[a:b])
        out = []
        for r, i in sorted(pairs):
            item, text = self.words[i], hashes[parsed.rows[r]:parsed.rows[r + 1]]
            least = min(SEED, len(item))
            runs = _common_runs(text, item, least)
            found = tiles(item, runs, least)
            covered = sum(n for n, _, _ in found)
            if covered >= coverage * len(item):
                out.append((r, i, len(found), covered, covered / len(item)))
        return out


def _common_runs(text: np.ndarray, item: np.ndarray, least: int) -> np.ndarray:
    """The runs of `least` words or more that all occur in the item, a gap between each two."""
    inside = np.isin(text, item)
    ends = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
    kept = [x for a, b in zip(ends[::2].tolist(), ends[1::2].tolist()) if b - a >= least for x in (text[a:b], [_GAP])]
    return np.concatenate(kept).astype(np.uint64) if kept else np.zeros(0, np.uint64)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """The benchmark's rows, a block at a time; blocks are dealt by hash, as many as its size asks for."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).where(
        "text is not null")
    total = items.agg(F.sum(F.length("text") + F.lit(16))).first()[0] or 0
    n = max(1, -(-2 * total // BLOCK_BYTES))
    for block in range(n):
        rows = [(r[0], bytes(r[1])) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()]
        if rows:
            yield sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def matches(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """A row for every document and item whose coverage is reached; see the module for each case."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    out = spark.createDataFrame([], MATCHES)
    for rows in _blocks(benchmark):
        block = spark.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            items = Items(block.value)
            for part in textkit.cuts(batches):
                found = items.matches(part.column("text"), coverage)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array([m[0] for m in found], pa.int64())),
                    pa.array([items.ids[m[1]] for m in found], pa.int64()), pa.array([m[2] for m in found], pa.int32()),
                    pa.array([m[3] for m in found], pa.int32()), pa.array([len(items.words[m[1]]) for m in found], pa.int32()),
                    pa.array([m[4] for m in found], pa.float64())],
                    ["doc_id", "item_id", "n_tiles", "covered_words", "item_words", "coverage"])

        out = out.unionByName(texts.mapInArrow(run, MATCHES))
    return out


def clean(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of documents, all columns, that no item contaminates."""
    for rows in _blocks(benchmark):
        block = documents.sparkSession.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            items = Items(block.value)
            for part in textkit.cuts(batches):
                bad = {m[0] for m in items.matches(part.column("text").cast(pa.binary()), coverage)}
                yield part.filter(pa.array([r not in bad for r in range(part.num_rows)], pa.bool_()))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
