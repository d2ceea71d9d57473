import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from fixtures import awkward, documents, fold, prose, row
from meterloom.llm import lm_scoring, mixing, token_store, toxicity
from meterloom.session import scratch, settle

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def size(text):
    return len(fold(text))


def targets(rows):
    """Targets by sharing what is above a limit again and again."""
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, stopped, left = dict.fromkeys(order, 0.0), set(), float(sum(sizes.values()))
    while left > 1e-9:
        open_ = [s for s in order if s not in stopped]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        left = 0.0
        for s in open_:
            target[s] += share[s]
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                stopped.add(s)
    return sizes, target


MIXED = [(i, prose(i, 20 + i % 50), f"s{i % 9}" if i % 3 else "hot") for i in range(240)] + [
    (1000, prose(1, 4000), "Z"), (1001, "one", "tiny"), (1002, "", "none"), (1003, None, "none"), (1004, prose(3, 70), None), (1004, prose(3, 70), None)]


@pytest.mark.parametrize("rows", [MIXED, awkward(), [(1, None, "a")], []], ids=["mixed", "awkward", "wordless", "empty"])
def test_mixing(spark, rows):
    sizes, target = targets(rows)
    got = mixing.taken(documents(spark, rows)).collect()
    assert sorted((repr(r.doc_id), repr(r.source), r.size, r.source_size) for r in got) == sorted(
        (repr(d), repr(s), size(t), sizes[s]) for d, t, s in rows)
    given = collections.Counter()
    for r in got:
        assert abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r.size
        given[r.source] += r.taken
    assert all(abs(given[s] - target[s]) <= 0.5 for s in target)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.taken(documents(spark, rows[::-1])).collect()))


def test_targets_of_more_words_than_an_int_holds(spark):
    """A weight times the words that are shared passes 2^31, though the words do not."""
    sizes = {"=a": 300_000_000, "=b": 900_000_000, "=c": 40_000_000, "=d": 700_000_000}
    rows = spark.createDataFrame([(s, s[1:], part) for s, n in sizes.items() for part in (n // 4, n - n // 4)], "s string, source string, size long")
    got = {r.s: (r.source_size, r.target, r.whole) for r in mixing.targets(rows).collect()}
    words, full = sum(sizes.values()), 3 * sizes["=c"]
    assert 3 * sizes["=a"] > (words - full) * 5 / 12 and words < 2 ** 31 < 5 * (words - full)
    want = {"=a": (words - full) * 5 / 12, "=b": (words - full) * 2 / 12, "=c": full, "=d": (words - full) * 5 / 12}
    assert {s: t[0] for s, t in got.items()} == sizes and all(abs(got[s][1] - want[s]) < 1e-3 for s in want)
    assert all(got[s][2] == math.floor(want[s] + 0.5) for s in want)


def test_schedule_is_even(spark):
    rows = mixing.sized(documents(spark, MIXED))
    sources = settle(mixing.targets(rows), "targets")
    slots = sorted(mixing.schedule(sources).collect(), key=lambda r: r.slot)
    wanted = {r.s: r.whole for r in sources.collect()}
    total, count = sum(wanted.values()), collections.Counter()
    for n, slot in enumerate(slots, 1):
        assert slot.rank == count[slot.s]
        count[slot.s] += 1
        assert abs(count[slot.s] - n * wanted[slot.s] / total) <= 2 + math.log2(len(slots))


def test_mixed_documents(spark):
    rows = [r for r in MIXED if r[0] != 1004]
    taken = {r.doc_id: r.taken for r in mixing.taken(documents(spark, rows)).collect()}
    out = mixing.mixed(documents(spark, rows))
    words, texts = collections.Counter(), {d: t for d, t, _ in rows}
    for r in out.collect():
        words[r.doc_id] += size(r.text)
        assert fold(texts[r.doc_id])[:size(r.text)] == fold(r.text) and r.n_chars == len(r.text) and r.component == "c"
    assert words == {d: n for d, n in taken.items() if n} and out.columns == documents(spark, []).columns


def test_token_ids(spark):
    from tokenizers import Tokenizer
    rows = awkward() + [(60, "a  b\n c  d <|endoftext|> e.,  ", "a"), (61, " lead. it's, don't. x  y 3.5, z", "a"), (-5, "neg", "a")]
    folder = scratch(spark, "ids")
    manifest = settle(token_store.write(documents(spark, rows), folder, TOKENIZER, shard_ids=3_000), "manifest")
    got = token_store.digests(spark, folder, manifest).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    digest = collections.Counter()
    ids = {}
    for d, t, _ in rows:
        own = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        ids.setdefault(d, []).append(own)
        digest[d, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == digest
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0)) and manifest.count() > 2
    # Keyed access, and keys that are not there.
    shards = [token_store.Shard.read(bytes(r.content)) for r in spark.read.format("binaryFile").load(folder).collect()]
    for d, own in ids.items():
        found = [list(map(int, x)) for s in shards for x in s.documents(d)]
        assert sorted(found) == sorted(own)
    assert not any(s.documents(d) for s in shards for d in (8, 10 ** 12, -1))


def test_new_words_are_encoded_together():
    """Calls of the tokenizer grow with the texts and with thousands of new words, not with each word."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abdeimnorstuäéß'7,.#\n") for _ in range(rng.randrange(2, 12))).strip() or "x" for _ in range(6_000)]
    texts = [" ".join(words[i:i + 500]) for i in range(0, 6_000, 500)] + ["", " ", "a  b\n c  d e.,  ", " lead \n x", "z\t y"]
    encoder, calls = token_store.Encoder(TOKENIZER, "<u2"), []
    ids = encoder._ids
    encoder._ids = lambda own: (calls.append(len(own)), ids(own))[1]
    got = encoder.encode(texts)
    assert sum(calls) < 100
    assert got == [own + encoder.end for own in ids(texts)] == encoder.encode(texts)


def test_words_cut_by_tokens_that_do_not_fit():
    """Words whose number of spaced tokens is not theirs are encoded one by one."""
    encoder = token_store.Encoder(TOKENIZER, "<u2")
    wanted = encoder.encode(["a bcd efg. h"])
    other = token_store.Encoder(TOKENIZER, "<u2")
    other.begins[:] = False
    assert other.encode(["a bcd efg. h"]) == wanted == [encoder._ids(["a bcd efg. h"])[0] + encoder.end]


def test_perfect_hash_is_minimal():
    keys = token_store._keys(np.random.default_rng(1).permutation(50_000).astype(np.int64), np.zeros(50_000, bool))
    sizes, bits = token_store.build(keys)
    before = np.concatenate([[0], np.cumsum(bits.reshape(-1, 64).sum(1))])[:-1]
    assert sorted(token_store.ranks(keys, sizes, bits, before).tolist()) == list(range(50_000))


def test_no_documents_no_shards(spark):
    folder = scratch(spark, "ids")
    manifest = settle(token_store.write(documents(spark, []), folder, TOKENIZER), "manifest")
    assert token_store.digests(spark, folder, manifest).count() == 0


def labelled():
    """Texts of which some hold one of a few bad words, spelt in ways that the training texts need not show."""
    rng, rows, labels = random.Random(5), [], []
    for i in range(900):
        words, bad = prose(i, rng.randrange(15, 60), 3_000).split(), i % 5 == 0
        for _ in range(1 + len(words) // 25 if bad else 0):
            word = rng.choice(["grumblor", "snarkwid", "fleebozz"])
            words.insert(rng.randrange(len(words)), word + rng.choice(["", "s", "ed", f"{rng.randrange(99)}", "!"]))
        rows.append((i, " ".join(words), "a"))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = labelled()
    extra = [(5000, None, "a"), (5001, "", "a"), (5002, "grumblorx you snarkwidx", "a"), (None, "x", "a"), (3, "second row of an id", "a")]
    table = spark.createDataFrame([*labels, (0, 0), (None, 1), (7, None), (9999, 1)], "doc_id long, toxic int")
    documents_ = documents(spark, rows + extra)
    got = toxicity.scores(documents_, table).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    truth = dict(labels)
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    by_id = {r.doc_id: r.predicted for r in got}
    assert by_id[5002] == 1 and by_id[5000] == by_id[5001] == 0
    kept = toxicity.clean(documents_, table)
    assert kept.columns == documents_.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_toxicity_without_both_labels(spark):
    rows = documents(spark, [(i, prose(i), "a") for i in range(10)])
    one = spark.createDataFrame([(i, 1) for i in range(10)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.scores(rows, one).collect()} == {1.0}
    assert {r.score for r in toxicity.scores(rows, one.limit(0)).collect()} == {0.0}
    assert toxicity.scores(rows.limit(0), one).count() == 0


def test_lm_scores(spark):
    rows = awkward() + [(600 + i, prose(i, 40, 200) + f" rare{i}", "a") for i in range(60)]
    got = lm_scoring.score(documents(spark, rows)).collect()
    learnt = [t for d, t, _ in rows if d is not None and zlib.crc32(str(d).encode()) % 10]
    c = collections.Counter(x for t in learnt for x in [*fold(t), None])
    n, v = sum(c.values()), len(c)
    want = []
    for d, t, _ in rows:
        own = [*fold(t), None]
        want.append((repr(d), d is None or zlib.crc32(str(d).encode()) % 10 == 0, len(own), sum(c[x] > 0 for x in own), n,
                     round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in own), 6)))
    assert sorted(want) == sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert all(r.score < 0 for r in got)


def test_lm_words_joined_or_broadcast_alike(spark, monkeypatch):
    rows = documents(spark, [(i, prose(i, 40, 200), "a") for i in range(40)])
    first = {r.doc_id: r.score for r in lm_scoring.score(rows).collect()}
    monkeypatch.setattr(lm_scoring, "COMMON", 0)
    for r in lm_scoring.score(rows).collect():
        assert abs(first[r.doc_id] - r.score) < 1e-9 * abs(r.score)


@pytest.mark.parametrize("share", [4, 1 << 19])
def test_lm_scores_are_those_of_the_whole_tree(spark, monkeypatch, share):
    """No entry of the tree is dropped, however rare: scores are those of the tree of all entries."""
    import pyarrow as pa
    monkeypatch.setattr(lm_scoring, "SHARE", share)
    rows = awkward() + [(600 + i, prose(i, 60, 300) + f" rare{i} Straße{i % 3} zz{'q' * i}", "a") for i in range(60)] + [(900, "y" * 3000, "a")]
    got = lm_scoring.score(documents(spark, rows)).collect()
    learnt = [fold(t) for d, t, _ in rows if d is not None and zlib.crc32(str(d).encode()) % 10]
    c = collections.Counter(x for t in learnt for x in t)
    n, v = sum(c.values()) + len(learnt), len(c) + 1
    part = pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()))], ["word", "c"])
    ends = [(3, len(learnt)), ((1 << 56) | 32 << 8 | 3, len(learnt))]
    grams = collections.Counter(dict(ends))
    for p in lm_scoring._grams([part]):
        for code, count in zip(p.column(0).to_pylist(), p.column(1).to_pylist()):
            grams[code] += count
    codes, counts = np.array(list(grams), np.uint64), np.array(list(grams.values()))
    node = np.unique(codes >> np.uint64(8), return_inverse=True)[1]
    tree = lm_scoring.Tree(codes, counts, np.bincount(node, counts)[node].astype(np.int64), np.bincount(node)[node])
    assert 1 < tree.kept.sum() < len(tree.nodes)
    end = lm_scoring.blended(np.array([tree.end()]), np.array([len(learnt)]), n, v)[0]
    want = []
    for d, t, _ in rows:
        own = fold(t)
        want.append((repr(d), round(end + (lm_scoring.blended(tree.scores(own), np.array([c[x] for x in own]), n, v).sum() if own else 0), 6)))
    assert sorted(want) == sorted((repr(r.doc_id), round(r.score, 6)) for r in got)


def in_contexts(learnt, text, single, least, gain, longest):
    """log10 of a text's probability by counts of whole contexts; `single`: each token's log10 without any."""
    followers = collections.defaultdict(collections.Counter)
    for t in learnt:
        tokens = [*fold(t), None]
        for i, x in enumerate(tokens):
            for n in range(1, min(longest, i) + 1):
                followers[tuple(tokens[i - n:i])][x] += 1

    def log(context, x):
        if not context:
            return single[x]
        below, total, seen = log(context[1:], x), sum(followers[context].values()), followers[context]
        held = {y: c for y, c in seen.items() if c >= least}
        if not held:
            return below
        shares = {y: 10 ** log(context[1:], y) for y in held}
        told = sum(c * math.log(c / total / shares[y]) for y, c in held.items())
        left = total - sum(held.values())
        if left:
            told += left * math.log(left / total / (1 - sum(shares.values())))
        if told < gain + len(held) * math.log(total) / 2:
            return below
        rest = 1 - sum(c - lm_scoring.DISCOUNT for c in held.values()) / total
        return math.log10((max(held.get(x, 0) - lm_scoring.DISCOUNT, 0)) / total + rest * 10 ** below)

    tokens = [*fold(text), None]
    return sum(log(tuple(tokens[max(0, i - longest):i]), x) for i, x in enumerate(tokens))


@pytest.mark.parametrize("places", [2, 1 << 21])
def test_lm_contexts_are_words_before(spark, monkeypatch, places):
    """A text's score is that of each token after the words before it; shuffled, the same words score lower."""
    monkeypatch.setattr(lm_scoring, "PLACES", places)
    rng = random.Random(8)
    phrases = ["the cat sat on the mat", "a dog ran to the cat", "the mat of a dog", "on the cat ran a mat", "a B the b"]
    rows = [(i, " ".join(rng.choice(phrases) for _ in range(8)), "a") for i in range(60)]
    rows += [(100, None, "a"), (None, "the cat the mat", None), (200, "the cat sat on zebra mat", "a"), (3, rows[3][1], "a")]
    mixed = rows[5][1].split()
    rng.shuffle(mixed)
    held_out = [i for i in range(1000, 1400) if zlib.crc32(str(i).encode()) % 10 == 0]
    single_words = sorted({x for _, t, _ in rows for x in fold(t)})
    rows += [(held_out[0], rows[5][1], "a"), (held_out[1], " ".join(mixed), "a"), (held_out[2], "", "a")]
    rows += [(i, w.decode(), "b") for i, w in zip(held_out[3:], single_words)]
    learnt = [t for d, t, _ in rows if d is not None and zlib.crc32(str(d).encode()) % 10]
    monkeypatch.setattr(lm_scoring, "LEAST", 10 ** 9)
    alone = {r.doc_id: r.score for r in lm_scoring.score(documents(spark, rows)).collect()}
    single = {None: alone[held_out[2]]} | {w: alone[i] - alone[held_out[2]] for i, w in zip(held_out[3:], single_words)}
    assert abs(alone[held_out[0]] - alone[held_out[1]]) < 1e-9
    monkeypatch.setattr(lm_scoring, "LEAST", 3)
    got = lm_scoring.score(documents(spark, rows)).collect()
    want = sorted((repr(d), round(in_contexts(learnt, t, single, 3, lm_scoring.GAIN, lm_scoring.WORDS), 6)) for d, t, _ in rows)
    assert want == sorted((repr(r.doc_id), round(r.score, 6)) for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[held_out[0]] > score[held_out[1]] + 5


def test_lm_of_nothing(spark):
    assert lm_scoring.score(documents(spark, [])).count() == 0
    [only] = lm_scoring.score(documents(spark, [(None, "a b", "a")])).collect()
    assert (only.n_tokens, only.n_known, only.train_tokens) == (3, 0, 0) and only.score < 0


def test_tree_is_a_distribution():
    """The tree's shares of all symbols in a context add up to 1, and the scores are sums of their logs."""
    import pyarrow as pa
    words = [f"{a}{b}{c}".encode() for a in "abc" for b in "aab" for c in ("", "x", "yz")]
    counts = np.arange(1, len(words) + 1) * 40
    parts = list(lm_scoring._grams([pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts)], ["word", "c"])]))
    codes, at = np.unique(np.concatenate([np.asarray(p.column(0)).view(np.uint64) for p in parts]), return_inverse=True)
    c = np.bincount(at, np.concatenate([np.asarray(p.column(1)) for p in parts])).astype(np.int64)
    node = np.unique(codes >> np.uint64(8), return_inverse=True)[1]
    kept = c >= 200
    tree = lm_scoring.Tree(codes[kept], c[kept], np.bincount(node, c)[node][kept].astype(np.int64), np.bincount(node)[node][kept])
    assert 1 < tree.kept.sum() < len(tree.nodes) or tree.kept.any()
    for prefix in (b"", b"a", b"ab", b"cbx"):
        total = 0.0
        base = tree.scores([prefix])[0] if prefix else 0.0
        # P(prefix then any byte then the rest) summed over bytes, one symbol at a time
        data = np.array([[*b" " + prefix, s] for s in range(256)], np.uint8)
        for line in data:
            before = np.arange(len(line))
            share = np.full(len(line), 1 / 256)
            for depth, place, context in lm_scoring._contexts(line, before):
                own = tree._find(tree.nodes, (np.uint64(depth) << np.uint64(48)) | context)
                known = (own >= 0) & tree.kept[np.maximum(own, 0)]
                place, own, context = place[known], own[known], context[known]
                entry = tree._find(tree.codes, lm_scoring._code(depth, context, line[place]))
                share[place] = (np.where(entry >= 0, tree.counts[np.maximum(entry, 0)], 0) + tree.lower[own] * share[place]) / tree.whole[own]
            total += share[-1]
        assert abs(total - 1) < 1e-9 and base <= 0


def test_rows_helper():
    assert len(row(1, "x")) == 16


def test_mix_of_weights_that_pass_an_int(spark, monkeypatch):
    """The pipeline's stage 4: weights times words may pass 2^31; equal ratios give equal documents."""
    import corpus_pipeline
    docs = documents(spark, MIXED)
    stage = dict(corpus_pipeline.STAGES)["mixing sources to target weights"]
    want = stage(spark, docs, "").collect()
    monkeypatch.setattr(mixing, "WEIGHTS", tuple(w * 10 ** 8 for w in mixing.WEIGHTS))
    got = stage(spark, docs, "").collect()
    assert want and sorted(map(repr, got)) == sorted(map(repr, want))
