"""LM scoring by probabilistic suffix trees.

Tokens are words (A-Z lower-cased), then one end per document. A tree of bytes models a token as its bytes followed by a space,
and the end as a byte of its own where a word would begin. A context is the bytes before a symbol, back to the space before
the word and DEPTH at most, so this tree is learnt from the counts of distinct words and scores distinct words.

A word met in training is also one symbol, with its count less DISCOUNT of all tokens; what the discounts free is the
share of words spelled out by the tree, so a word's probability is the sum of both, and words never met have one.

A context is kept if it tells: the gain in log likelihood of its symbols, by the divergence of their distribution from that
of the context one byte shorter times their number, is GAIN or more. Contexts below a kept one are kept. A symbol's
probability in a context is its count there plus its probability in the context one byte shorter times SMOOTH imagined
counts per distinct symbol of the context; below the root lies an even share of 256 symbols. The longest kept suffix of
what stands before a symbol gives its probability. The tree stays a table, with an entry for every symbol that stands in a
context of DEPTH bytes or fewer in any word: nothing but the gain prunes it, so what it holds grows with the corpus. Entries
are joined by their code, of which a shorter one has 256 longer ones at most, so no key is hot. The distinct words' symbols
are joined to the entries of their longest contexts; entries that make up one in SHARE of all symbols or more (at most
SHARE of them) are broadcast instead, which changes no score. So it is with words: those that make up one in COMMON of all
tokens or more (at most COMMON of them) are broadcast, the others' tokens are joined to their counts.

Before that stands the tree over tokens, whose contexts are the WORDS words before a token, or fewer. It grows a word at a
time: a token after a context is counted only if it was met LEAST times after the context without its first word, and the
context itself was met LEAST times, since no other can be met so often; these two tests go through a bit set of hashes, which
lets some more pass but none less, so the counts are exact. A context is kept by the divergence test too, its tokens met
fewer times taken together; as they are many, each held token raises what the gain must reach by half the log of the
context's count, which is what chance alone gives. In a kept context a token has its count there less DISCOUNT, over the context's count, plus its
probability in the context one word shorter times what the discounts and the tokens met fewer times leave. So every token
has the probability of its longest kept context, and the shares of all tokens add up to 1. A document's score is that of
its words alone plus what every kept context and every token held in one adds wherever it stands, so these numbers are a
table of sequences of words, which grows with the corpus; sequences that are one in PLACES of all tokens or more are
broadcast, the others joined. A document begins without a context.

`base_score` is the sum over tokens of log10((c + 0.1) / (N + 0.1 (V + 1))) as the caller's contract has it.

Null and empty texts hold one token, the end. A null doc_id is held out and keeps its row; rows that repeat are counted and
returned one by one. Without training rows N and V are 0 and the tree knows only even shares. An empty table gives an empty
one; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from meterloom.llm import textkit
from meterloom.session import settle

DEPTH = 5
GAIN = 8.0
SMOOTH = 0.5
DISCOUNT = 0.5
SHARE = 1 << 19
COMMON = 1 << 20
PLACES = 1 << 21
WORDS = 2
LEAST = 64
#: Bits of a sieve, and bytes of text a task takes at once; twice as many where it counts words or pairs only.
SIEVE = 1 << 25
CUT = 1 << 20
_SPACE, _END = 32, 3
_END_CODE = 1 << 56 | _SPACE << 8 | _END
_END_HASH = np.uint64(0xE703_7ED1_A0B4_28DB)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(True))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each cut and how often they stand in training rows and in all."""
    for part in textkit.cuts(batches, limit=2 * CUT):
        parsed = textkit.words(part.column("text"))
        values, first, inverse = np.unique(parsed.hashes(), return_index=True, return_inverse=True)
        learnt = np.asarray(part.column("learnt"), bool)[parsed.row_of()]
        counts = np.bincount(inverse, learnt, len(values)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(textkit.ids(values)), parsed.texts(first), pa.array(counts)], ["h", "word", "c"])


def _symbols(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of ` word ` of every word, the bytes that stand before each in its word, and the word of each."""
    joined = np.frombuffer(b"".join(b" " + w + b" " for w in words), np.uint8)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    return joined, np.arange(len(joined)) - np.repeat(np.cumsum(lengths) - lengths, lengths), owner


def _contexts(data: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, places that have a context so long, the contexts as numbers)."""
    code = np.zeros(len(data), np.uint64)
    at = np.flatnonzero(before > 0)
    yield 0, at, code[at]
    for depth in range(1, DEPTH + 1):
        at = np.flatnonzero(before >= depth)
        code[at] |= data[at - depth].astype(np.uint64) << np.uint64(8 * (depth - 1))
        yield depth, at, code[at]


def _code(depth: int, contexts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    return (np.uint64(depth) << np.uint64(56)) | (contexts << np.uint64(8)) | symbols.astype(np.uint64)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of every symbol in every context of the words."""
    for batch in batches:
        for start in range(0, batch.num_rows, 50_000):
            part = batch.slice(start, 50_000)
            data, before, owner = _symbols(part.column("word").to_pylist())
            counts = np.asarray(part.column("c"), np.float64)
            for depth, at, context in _contexts(data, before):
                values, inverse = np.unique(_code(depth, context, data[at]), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(textkit.ids(values)), pa.array(np.bincount(inverse, counts[owner[at]]).astype(np.int64))],
                                                 ["code", "c"])


def _leaves(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The code of every symbol of the words in its longest context, and its word."""
    data, before, owner = _symbols(words)
    codes = np.zeros(len(data), np.uint64)
    for depth, at, context in _contexts(data, before):
        codes[at] = _code(depth, context, data[at])
    return codes[before > 0], owner[before > 0]


class Tree:
    """The suffix tree of entries that fit one process: kept contexts, and for each the smoothed shares of its symbols. The
    plain form of what `entries` computes as tables; tests compare the two."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, totals: np.ndarray, symbols: np.ndarray):
        """Entries: code and count; totals and symbols: all symbols and distinct symbols of the entry's context, those of
        entries left out included."""
        order = np.argsort(codes)
        self.codes, counts = codes[order], counts[order].astype(np.float64)
        depth = (self.codes >> np.uint64(56)).astype(np.int64)
        self.nodes, first, node = np.unique(self.codes >> np.uint64(8), return_index=True, return_inverse=True)
        self.totals = totals[order][first].astype(np.float64)
        #: What the shorter context's distribution counts for: SMOOTH per distinct symbol, and the entries left out.
        self.lower = SMOOTH * symbols[order][first] + self.totals - np.bincount(node, counts, len(self.nodes))
        self.whole = self.totals + SMOOTH * symbols[order][first]
        symbol = self.codes & np.uint64(255)
        node_depth = (self.nodes >> np.uint64(48)).astype(np.int64)
        context = self.nodes & np.uint64((1 << 48) - 1)

        def shorter(d, c):  # the context without its first byte
            return (np.uint64(d - 1) << np.uint64(48)) | (c & np.uint64((1 << (8 * (d - 1))) - 1))

        gain, keep = np.zeros(len(self.nodes)), node_depth == 0
        self.given = np.zeros(len(self.codes))
        up = np.full(len(self.nodes), -1, np.int64)
        for d in range(1, DEPTH + 1):
            own = np.flatnonzero(node_depth == d)
            up[own] = self._find(self.nodes, shorter(d, context[own]))
        for d in range(1, DEPTH + 1):
            at = np.flatnonzero(depth == d)
            parent = up[node[at]]
            above = self._find(self.codes, (self.nodes[np.maximum(parent, 0)] << np.uint64(8)) | symbol[at])
            fine = (parent >= 0) & (above >= 0)
            at, parent, above = at[fine], parent[fine], above[fine]
            own = counts[at] / self.totals[node[at]]
            gain += np.bincount(node[at], counts[at] * np.log(own * self.totals[parent] / counts[above]), len(self.nodes))
        keep |= gain >= GAIN
        for d in range(DEPTH, 0, -1):
            own = np.flatnonzero((node_depth == d) & keep & (up >= 0))
            keep[up[own]] = True
        self.kept = keep
        self.counts = counts

    @staticmethod
    def _find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The place of each value in a sorted table, or -1."""
        if len(table) == 0:
            return np.full(len(values), -1, np.int64)
        at = np.minimum(np.searchsorted(table, values), len(table) - 1)
        return np.where(table[at] == values, at, -1)

    def scores(self, words: list[bytes]) -> np.ndarray:
        """log10 of each word's probability, the space after it included."""
        data, before, owner = _symbols(words)
        share = np.full(len(data), 1 / 256)
        for depth, at, context in _contexts(data, before):
            node = self._find(self.nodes, (np.uint64(depth) << np.uint64(48)) | context)
            known = (node >= 0) & self.kept[np.maximum(node, 0)] if len(self.nodes) else np.zeros(len(at), bool)
            at, node, context = at[known], node[known], context[known]
            entry = self._find(self.codes, _code(depth, context, data[at]))
            count = np.where(entry >= 0, self.counts[np.maximum(entry, 0)], 0) if len(self.codes) else 0
            share[at] = (count + self.lower[node] * share[at]) / self.whole[node]
        return np.bincount(owner, np.where(before > 0, np.log10(share), 0), len(words))

    def end(self) -> float:
        """log10 of the end's probability where a word would begin."""
        share = 1 / 256
        for depth, context in ((0, 0), (1, _SPACE)):
            node = self._find(self.nodes, np.array([(depth << 48) | context], np.uint64))[0]
            if node >= 0 and self.kept[node]:
                entry = self._find(self.codes, np.array([(depth << 56) | context << 8 | _END], np.uint64))[0]
                share = ((self.counts[entry] if entry >= 0 else 0) + self.lower[node] * share) / self.whole[node]
        return float(np.log10(share))


def blended(spelled: np.ndarray, counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """log10 of each token's probability: its own discounted share of n training tokens, and its share of what the v
    distinct tokens' discounts free."""
    if not n:
        return spelled
    with np.errstate(divide="ignore"):
        seen = np.log10(np.maximum(counts - DISCOUNT, 0) / n)
    return np.logaddexp(seen * np.log(10), (spelled + np.log10(DISCOUNT * v / n)) * np.log(10)) / np.log(10)


def _depth(code: Column) -> Column:
    return F.shiftright(code, 56).cast("int")


def _cut(code: Column, depth: Column, low: int) -> Column:
    """A code (low = 8) or context (low = 0) cut to `depth` bytes of context."""
    bits = (depth * 8 + low).cast("int")
    return F.call_function("shiftleft", depth.cast("long"), F.lit(48 + low)).bitwiseOR(
        code.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1))


def entries(words: DataFrame, n_docs: int) -> tuple[DataFrame, int]:
    """(code, c, lp) of every symbol of the words (word, c) in its longest context: its training count and log10 of its
    share; and the number of training symbols. n_docs ends are counted too, and have their entry always."""
    spark = words.sparkSession
    ends = spark.createDataFrame([(_END, n_docs), (_END_CODE, n_docs)], "code long, c long")
    grams = words.select("word", "c").mapInArrow(_grams, "code long, c long").unionByName(ends).groupBy("code").agg(F.sum("c").alias("c"))
    grams = settle(grams.withColumn("node", F.shiftright("code", 8)), "grams")
    seen = grams.where("c > 0")
    total = seen.where(_depth(F.col("code")) == 0).agg(F.sum("c")).first()[0] or 0
    nodes = settle(seen.groupBy("node").agg(F.sum("c").alias("total"), F.count("*").alias("symbols")), "nodes")

    depth, node_depth = _depth(F.col("code")), F.shiftright("node", 48).cast("int")
    above = seen.select(F.col("code").alias("up"), F.col("c").alias("above"))
    told = seen.where(depth > 0).withColumn("up", _cut(F.col("code"), depth - 1, 8)).join(above, "up").groupBy("node").agg(
        F.sum(F.col("c") * F.log(F.col("c") / F.col("above"))).alias("gain"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("total").alias("parent_total"))
    gain = F.col("gain") + F.col("total") * F.log(F.col("parent_total") / F.col("total"))
    telling = nodes.where(node_depth > 0).withColumn("parent", _cut(F.col("node"), node_depth - 1, 0)).join(parents, "parent").join(told, "node").where(
        gain >= GAIN).select(F.col("node").alias("own"), F.explode(F.sequence(F.lit(1), node_depth)).alias("d"))
    kept = telling.select(_cut(F.col("own"), F.col("d"), 0).alias("node")).distinct().join(nodes, "node").unionByName(nodes.where(node_depth == 0))
    whole = F.col("total") + SMOOTH * F.col("symbols")
    steps = settle(grams.join(kept, "node", "left").select(  # share = own + lower * the share in the shorter context
        "code", "c", depth.alias("depth"), F.coalesce(F.col("c") / whole, F.lit(0.0)).alias("own"),
        F.coalesce(SMOOTH * F.col("symbols") / whole, F.lit(1.0)).alias("lower")), "steps")

    shares = steps.where("depth = 0").select("code", (F.col("own") + F.col("lower") / 256).alias("share"))
    leaves = []
    for d in range(1, DEPTH + 1):
        up = shares.select(F.col("code").alias("up"), F.col("share").alias("above"))
        shares = settle(steps.where(F.col("depth") == d).withColumn("up", _cut(F.col("code"), F.lit(d - 1), 8)).join(up, "up").select(
            "code", "c", (F.col("own") + F.col("lower") * F.col("above")).alias("share")), "shares")
        begins = F.shiftright("code", 8 * d).bitwiseAND(255) == _SPACE  # the context reaches back to the space before the word
        leaves.append(shares if d == DEPTH else shares.where(begins))
    out = leaves[0]
    for more in leaves[1:]:
        out = out.unionByName(more)
    return out.select("code", "c", F.log10("share").alias("lp")), total


def spelled(words: DataFrame, leaves: DataFrame, total: int) -> DataFrame:
    """Adds `spelled` to the words (h, word, c): log10 of each word's probability by the tree, the space after it included."""
    spark = words.sparkSession
    often = leaves.where((F.col("c") > 0) & (F.col("c") * SHARE >= total)).select("code", "lp").toArrow()
    codes = np.asarray(often.column("code"), np.int64).view(np.uint64)
    order = np.argsort(codes)
    frequent = spark.sparkContext.broadcast((codes[order], np.asarray(often.column("lp"), np.float64)[order]))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per word a row with the sum over its frequent symbols, and one row per other symbol."""
        codes, logs = frequent.value
        names, task, seen = ["row", "h", "word", "c", "lp", "code"], TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 50_000):
                part = batch.slice(start, 50_000)
                leaf, owner = _leaves(part.column("word").to_pylist())
                at = Tree._find(codes, leaf)
                known = at >= 0
                row_ids = (task << 40) + seen + np.arange(part.num_rows)
                seen += part.num_rows
                sums = np.bincount(owner[known], logs[at[known]], part.num_rows).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(row_ids), *part.columns, pa.array(sums), pa.nulls(part.num_rows, pa.int64())], names)
                k = int((~known).sum())
                yield pa.RecordBatch.from_arrays([pa.array(row_ids[owner[~known]]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64()),
                                                  pa.nulls(k, pa.float64()), pa.array(textkit.ids(leaf[~known]))], names)

    rows = settle(words.select("h", "word", "c").mapInArrow(parts, "row long, h long, word binary, c long, lp double, code long"), "spelled")
    rare = rows.where("code is not null").select("row", "code").join(leaves.select("code", F.col("lp").alias("each")), "code").groupBy("row").agg(
        F.sum("each").alias("rare"))
    return rows.where("code is null").select("row", "h", "word", "c", "lp").join(rare, "row", "left").select(
        "h", "word", "c", (F.col("lp") + F.coalesce("rare", F.lit(0.0))).alias("spelled"))


def _sequences(parsed: textkit.Words, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(n, row, code, context, shorter) of every token that has n tokens before it in its row: hashes of the token with the n
    before it, of these n alone, and of all but the first. For n = 0 there is only the code."""
    sizes = np.diff(parsed.rows)
    row = np.repeat(np.arange(len(sizes)), sizes + 1)
    code = np.full(len(row), _END_HASH)
    word = np.ones(len(row), bool)
    word[np.cumsum(sizes + 1) - 1] = False
    code[word] = hashes
    yield 0, row, code, code[:0], code[:0]
    for n in range(1, WORDS + 1):
        joined = row[1:] == row[:-1]
        context, shorter = code[:-1], code[1:]
        code = textkit.mix(context * np.uint64(0xD6E8FEB86659FD93) + shorter * np.uint64(0x9FB21C651E98DF25) + np.uint64(n))
        # what crosses rows is cut out, and stays out of longer ones: a row's first token is never a second one
        row, code, context, shorter = row[1:][joined], code[joined], context[joined], shorter[joined]
        yield n, row, code, context, shorter


def _passes(sieve: np.ndarray, codes: np.ndarray) -> np.ndarray:
    at = codes & np.uint64(SIEVE - 1)
    return sieve[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0


def sieve_of(codes: DataFrame) -> np.ndarray:
    """The bit set of hashes in the column `code`: of SIEVE bits, however many there are."""
    at = F.col("code").bitwiseAND(SIEVE - 1) + 1
    bits = np.zeros(SIEVE // 8, np.uint8)
    for block, packed in codes.groupBy(F.bitmap_bucket_number(at)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at))).collect():
        bits[(block - 1) * len(packed):block * len(packed)] = np.frombuffer(packed, np.uint8)
    return bits


def _grown(learnt: DataFrame, n: int, shorter: DataFrame) -> DataFrame:
    """What one reading of the texts tells: (code, context, shorter) of the sequences of n tokens in `shorter`, the column
    `context` null otherwise, and (code, c) of those of n + 1 tokens that the texts hold LEAST times or more."""
    held = learnt.sparkSession.sparkContext.broadcast(sieve_of(shorter))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textkit.cuts(batches, limit=2 * CUT if n == 1 else CUT):
            parsed = textkit.words(part.column("text"))
            for m, row, code, context, short in islice(_sequences(parsed, parsed.hashes()), n - 1, n + 1):
                if m == n:  # both parts are in `shorter`
                    values, counts = np.unique(code[both], return_counts=True)
                    empty = pa.nulls(len(values), pa.int64())
                    columns = [pa.array(textkit.ids(values)), empty, empty, pa.array(counts.astype(np.int64))]
                else:
                    passed = _passes(held.value, code)
                    both = (passed[:-1] & passed[1:])[row[1:] == row[:-1]]
                    if m == 0:
                        continue
                    near = np.flatnonzero(passed)
                    values, first = np.unique(code[near], return_index=True)
                    columns = [pa.array(textkit.ids(x)) for x in (values, context[near][first], short[near][first])] + [pa.nulls(len(values), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["code", "context", "shorter", "c"])

    found = learnt.mapInArrow(parts, "code long, context long, shorter long, c long").groupBy("code")
    if n == 1:
        return found.agg(F.sum("c").alias("c")).where(F.col("c") >= LEAST)
    return found.agg(*[F.max(x).alias(x) for x in ("context", "shorter")], F.sum("c").alias("c")).where(
        F.col("context").isNotNull() | (F.col("c") >= LEAST))


def contexts(learnt: DataFrame, tokens: DataFrame) -> DataFrame:
    """(code, c, adds): what every place of a sequence of tokens adds to the score beside the tokens' own logs. `learnt` has
    the training texts, `tokens` (code, c, lp) those met LEAST times or more, the end included."""
    told = tokens.select("code", "c", F.lit(0.0).alias("adds")).limit(0)
    counts = settle(_grown(learnt, 1, tokens), "sequences")
    for n in range(1, WORDS + 1):
        seen = settle(_grown(learnt, n + 1, counts), "sequences")
        held = settle(counts.select("code", "c").join(seen.where("context is not null").select("code", "context", "shorter"), "code").join(
            tokens.select(F.col("code").alias("shorter"), F.col("lp").alias("below")), "shorter"), "held")
        counts = seen.where("context is null").select("code", "c")
        c, share = F.col("c"), F.pow(F.lit(10.0), F.col("below"))
        found = held.groupBy(F.col("context").alias("code")).agg(
            F.sum("c").alias("held"), F.sum(c - DISCOUNT).alias("kept"), F.sum(share).alias("share"),
            F.sum(c * (F.log(c) - F.log(share))).alias("gain"), F.count("*").alias("tokens"))
        left = F.col("c") - F.col("held")
        gain = F.col("gain") - F.col("held") * F.log("c") + F.when(
            left > 0, left * (F.log(left / c) - F.log(F.greatest(1 - F.col("share"), F.lit(1e-12))))).otherwise(0.0)
        kept = settle(found.join(tokens.select("code", "c"), "code").where(
            gain >= GAIN + F.col("tokens") * F.log("c") / 2).select("code", "c", (1 - F.col("kept") / c).alias("rest")), "contexts")
        inside = held.join(kept.select(F.col("code").alias("context"), F.col("c").alias("total"), "rest"), "context", "left")
        lp = F.when(F.col("rest").isNull(), F.col("below")).otherwise(F.log10((c - DISCOUNT) / F.col("total") + F.col("rest") * share))
        tokens = settle(inside.select("code", "c", lp.alias("lp"), (lp - F.col("below") - F.log10("rest")).alias("adds")), "tokens-in-contexts")
        told = told.unionByName(kept.select("code", "c", F.log10("rest").alias("adds"))).unionByName(
            tokens.where("adds is not null").select("code", "c", "adds"))
    return settle(told.groupBy("code").agg(F.max("c").alias("c"), F.sum("adds").alias("adds")), "told")


def score(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row of documents; see the module
    for each case."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                             (~held_out(F.col("doc_id"))).alias("learnt"))
    counted = texts.mapInArrow(_counted, "h long, word binary, c long")
    words = settle(counted.groupBy("h", "word").agg(F.sum("c").alias("c")), "words")
    n_docs = texts.where("learnt").count()
    n_words, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    n, v = n_words + n_docs, distinct + (n_docs > 0)
    leaves, total = entries(words, n_docs)
    end = leaves.where(F.col("code") == _END_CODE).first().lp
    # as in `blended`; a word with no count of its own is only spelled, however small its share
    free = F.col("spelled") + (float(np.log10(DISCOUNT * v / n)) if n else 0.0)
    lp = F.when(F.col("c") > 0, F.log10((F.col("c") - DISCOUNT) / float(max(n, 1)) + F.pow(F.lit(10.0), free))).otherwise(free)
    scored = settle(spelled(words, leaves, total).select("h", "word", "c", lp.alias("lp")), "scored")
    end_lp = float(blended(np.array([end]), np.array([n_docs]), n, v)[0])
    ended = spark.createDataFrame([(int(textkit.ids(np.array([_END_HASH]))[0]), n_docs, end_lp)], "code long, c long, lp double")
    told = contexts(texts.where("learnt").select("text"), settle(
        scored.select(F.col("h").alias("code"), "c", "lp").unionByName(ended).where(F.col("c") >= LEAST), "tokens"))
    often = told.where(F.col("c") * PLACES >= n).select("code", "adds").toArrow()
    codes = np.asarray(often.column("code"), np.int64).view(np.uint64)
    order = np.argsort(codes)
    others = told.where(F.col("c") * PLACES < n)
    near = spark.sparkContext.broadcast((codes[order], np.asarray(often.column("adds"), np.float64)[order], sieve_of(told)))
    common = scored.where((F.col("c") > 0) & (F.col("c") * COMMON >= n)).select("h", "c", "lp").toArrow()
    h = np.asarray(common.column("h"), np.int64).view(np.uint64)
    order = np.argsort(h)
    top = spark.sparkContext.broadcast((h[order], np.asarray(common.column("c"), np.int64)[order], np.asarray(common.column("lp"))[order]))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per row a row with the sums over common words, and one per distinct word that is not common."""
        hashes, counts, logs = top.value
        codes, adds, sieve = near.value
        names = ["row", "doc_id", "h", "n", "n_known", "base", "lp", "code"]
        task, seen = TaskContext.get().partitionId(), 0
        for part in textkit.cuts(batches, limit=CUT):
            parsed = textkit.words(part.column("text"))
            own_hashes, of_row = parsed.hashes(), parsed.row_of()
            values, first, inverse = np.unique(own_hashes, return_index=True, return_inverse=True)
            at = Tree._find(hashes, values)
            row_ids = (task << 40) + seen + np.arange(part.num_rows)
            seen += part.num_rows
            known = at >= 0
            base = np.where(known, np.log10(counts[np.maximum(at, 0)] + 0.1) if len(counts) else 0.0, 0.0)
            logged = np.where(known, logs[np.maximum(at, 0)] if len(logs) else 0.0, 0.0)
            sums = [np.bincount(of_row, x[inverse], part.num_rows) for x in (known.astype(float), base, logged)]
            asked = []
            for _, row, code, _, _ in _sequences(parsed, own_hashes):
                own = np.flatnonzero(_passes(sieve, code))
                row, code = row[own], code[own]
                at = Tree._find(codes, code)
                own = at >= 0
                sums[2] += np.bincount(row[own], adds[at[own]], part.num_rows)
                asked.append((row[~own], code[~own]))
            yield pa.RecordBatch.from_arrays([
                pa.array(row_ids), part.column("doc_id"), pa.nulls(part.num_rows, pa.int64()), pa.array(np.diff(parsed.rows)),
                pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]), pa.nulls(part.num_rows, pa.int64())], names)
            row, code = (np.concatenate(x) for x in zip(*asked))
            k = len(row)
            yield pa.RecordBatch.from_arrays([pa.array(row_ids[row]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                                              pa.nulls(k, pa.int64()), pa.nulls(k, pa.float64()), pa.nulls(k, pa.float64()), pa.array(textkit.ids(code))], names)
            rest = np.flatnonzero(~known[inverse])
            pairs, times = np.unique(of_row[rest] * len(values) + inverse[rest], return_counts=True)
            k = len(pairs)
            yield pa.RecordBatch.from_arrays([
                pa.array(row_ids[pairs // max(1, len(values))]), pa.nulls(k, pa.int64()),
                pa.array(textkit.ids(values[pairs % max(1, len(values))])), pa.array(times.astype(np.int64)),
                pa.nulls(k, pa.int64()), pa.nulls(k, pa.float64()), pa.nulls(k, pa.float64()), pa.nulls(k, pa.int64())], names)

    rows = texts.mapInArrow(parts, "row long, doc_id long, h long, n long, n_known long, base double, lp double, code long")
    rows = settle(rows, "parts")
    rare = rows.where("h is not null").select("row", "h", "n").join(scored.select("h", "c", F.col("lp").alias("each")), "h").select(
        "row", F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"), (F.col("n") * F.log10(F.col("c") + 0.1)).alias("base"),
        (F.col("n") * F.col("each")).alias("lp"))
    placed = rows.where("code is not null").select("row", "code").join(others.select("code", F.col("adds").alias("lp")), "code").select(
        "row", F.lit(0).cast("long").alias("n_known"), F.lit(0.0).alias("base"), "lp")
    sums = rows.where("n is not null and h is null").select("row", "n_known", "base", "lp").unionByName(rare).unionByName(placed).groupBy("row").agg(
        *[F.sum(c).alias(c) for c in ("n_known", "base", "lp")])
    n_tokens = F.col("n") + 1
    end_count = float(np.log10(n_docs + 0.1))
    return rows.where("n is not null and h is null").select("row", "doc_id", "n").join(sums, "row").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), n_tokens.alias("n_tokens"),
        (F.col("n_known") + F.lit(int(n_docs > 0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + end_count - n_tokens * float(np.log10(n + 0.1 * (v + 1)))).alias("base_score"),
        (F.col("lp") + end_lp).alias("score"))
