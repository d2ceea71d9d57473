import random
import re
import time

import numpy as np

from fixtures import awkward, documents, fold, prose
from meterloom.llm import decontamination, license_scan, line_dedup, textkit, url_filter

PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
    found = [(i, label) for label, phrase in PHRASES.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), found


LICENSED = [(100, "Released under the MIT License.\nThe MIT license the mit LICENSE, the MIT-License", "a"), (101, "the mit", "a"),
            (102, prose(8) + " Apache License, Version 2.0 " + prose(9), "a"), (103, "cc-by-nc CC BY NC cc by", "a"),
            (104, "This work is licensed under the GNU General Public License, version 3.", "a"),
            (105, "licensed under the very GNU General Public License", "a"), (106, "cc by nc " * 40, "a"), (107, "ééthe mit license", "a"), (108, "The MIT license", "a"),
            (109, "x under the MIT license; under the mit-license", "a")]


def test_license_scan(spark):
    rows = awkward() + LICENSED + LICENSED[:1]
    got = license_scan.scan(documents(spark, rows)).collect()
    want = []
    for d, t, _ in rows:
        n, found = places(t)
        want.append((repr(d), n, len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None),
                     ",".join(sorted({label for _, label in found}))))
    assert sorted(map(repr, want)) == sorted(repr((repr(r.doc_id), *tuple(r)[1:6])) for r in got)
    labels = {r.doc_id: r.labels for r in got}
    assert labels[104] == labels[105] == "gpl" and labels[101] == "" and labels[100] == "mit"
    assert all(0 <= r.score <= 1 for r in got) and license_scan.scan(documents(spark, [])).count() == 0


def test_license_named_without_under(spark):
    """The contract's phrase counts places; the licence named by itself is still a notice, as it was before the phrase changed."""
    rows = [(1, "The MIT License, and nothing else", "a"), (2, "mit license", "a"), (3, "under the MIT license", "a")]
    got = {r.doc_id: r for r in license_scan.scan(documents(spark, rows)).collect()}
    assert [(got[d].n_base, got[d].base_labels, got[d].labels) for d in (1, 2, 3)] == [(0, "", "mit"), (0, "", ""), (1, "mit", "mit")]
    assert got[1].first_word is None and got[1].score == 1.0 and got[2].score == 0.0


def naive_stretches(rows, words):
    """What `clean` should give for (doc_id, text) rows, by trying every stretch of every document, shortest or not."""
    seen, by_row = set(), {}
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        own = [(j, tuple(fold(x))) for j, x in enumerate((t or "").split("\n"))]
        own, gone = [(j, w) for j, w in own if w], set()
        for lo in range(len(own)):
            for hi in range(len(own), lo, -1):
                n = sum(len(w) for _, w in own[lo:hi])
                if n < words and hi - lo < len(own):
                    continue
                # a stretch of fewer words counts as a whole document only
                key = (n < words, tuple(w for _, w in own[lo:hi]))
                if key in seen:
                    gone |= {j for j, _ in own[lo:hi]}
        for lo in range(len(own)):  # in order of the first line: within a document, a later stretch may repeat an earlier one
            for hi in range(lo + 1, len(own) + 1):
                key = tuple(w for _, w in own[lo:hi])
                n = sum(map(len, key))
                if n >= words and (False, key) in {(False, tuple(w for _, w in own[a:a + hi - lo])) for a in range(lo)}:
                    gone |= {j for j, _ in own[lo:hi]}
                if n >= words or hi - lo == len(own):
                    seen.add((n < words, key))
        by_row[d, t] = (t if not gone else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone), len(own), len(gone))
    return [(d, *by_row[d, t]) for d, t in rows]


def cleaned(spark, rows, words):
    return [tuple(r) for r in line_dedup.clean(documents(spark, [(d, t, "a") for d, t in rows]), words).collect()]


def test_line_dedup(spark):
    """Stretches of any number of lines, within and across documents, against every stretch tried."""
    rng = random.Random(6)
    lines = [prose(i, 2 + i % 7) for i in range(14)]
    passages = [[prose(500 + 10 * i + j, 3 + j) for j in range(4)] for i in range(3)]
    rows = []
    for i in range(70):
        own = []
        for j in range(rng.randrange(1, 9)):
            own += rng.choice(passages)[rng.randrange(2):] if rng.random() < 0.2 else [rng.choice(lines) if rng.random() < 0.5 else prose(1000 * i + j, 5)]
        rows.append((i, "\n".join(own)))
    rows += [(200, "a b\n\na b\n a B \na b"), (201, "\n\n"), (202, None), (203, ""), (204, rows[5][1] + "\n" + rows[6][1]), (205, "x\r\ny z"), (206, "x\ny z"),
             (206, "x\ny z"), (207, "\n".join(["one two three four"] * 12)), (208, rows[9][1].upper().replace(" ", "  ").replace("\n", "\n \n")), (None, rows[7][1])]
    rng.shuffle(rows)
    for words in (1, 12):
        want, got = naive_stretches(rows, words), cleaned(spark, rows, words)
        assert sorted(map(repr, got)) == sorted(map(repr, want)) and any(w[3] for w in want)
    assert line_dedup.clean(documents(spark, [])).count() == 0


def test_line_dedup_keeps_null_ids(spark):
    got = cleaned(spark, [(None, "p q\nr s"), (1, "P Q\n\nr s"), (2, "p q\nr s\nt"), (None, None)], 50)
    assert sorted((repr(r[0]), repr(r[1])) for r in got) == [("1", "''"), ("2", "'p q\\nr s\\nt'"), ("None", "'p q\\nr s'"), ("None", "None")]


def test_line_dedup_by_words(spark):
    """A passage of enough words goes wherever it stood earlier, on one line or many; one of fewer words stays."""
    rng = random.Random(16)
    long, short = [prose(i, 50 + i) for i in range(4)], [prose(40 + i, 49) for i in range(3)]
    many = "\n".join(prose(70 + i, 9) for i in range(6))
    rows = [(i, "\n".join(rng.choice(long + short) if rng.random() < 0.4 else prose(2000 * i + j, 5) for j in range(rng.randrange(1, 6)))) for i in range(50)]
    rows += [(100, long[0]), (101, long[0].upper()), (102, short[0] + "\nnot whole"), (103, "only"), (104, "only"), (105, "x y\nonly\nz"), (106, "\n only \n"),
             (107, long[1] + "\nmore of it\n" + long[1]), (None, "null first"), (108, "null first"), (108, "null first"), (109, None), (110, ""),
             (111, "before\n" + many + "\nafter"), (112, "other\n" + many.replace("\n", "\n\n") + "\nend")]
    rng.shuffle(rows)
    want, got = naive_stretches(rows, 50), cleaned(spark, rows, line_dedup.WORDS)
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    n_removed = {r[0]: r[3] for r in got}
    assert n_removed[101] == n_removed[104] == n_removed[106] == n_removed[108] == 1 and n_removed[102] == n_removed[105] == n_removed[111] == 0
    assert n_removed[112] == 6


def test_winnowing_leaves_most_lines_out(spark):
    """Fingerprints of short lines are far fewer than lines, and a long text of distinct lines joins nothing."""
    rows = [(i, "\n".join(prose(10_000 * i + j, 6) for j in range(400))) for i in range(5)]
    found = line_dedup.fingerprints(documents(spark, [(d, t, "a") for d, t in rows]))
    assert 2000 / 9 < found.count() < 2000 / 2
    assert line_dedup.repeats(documents(spark, [(d, t, "a") for d, t in rows])).count() == 0


def test_windows_hold_enough_words():
    rng = np.random.default_rng(3)
    sizes, rows = rng.integers(1, 30, 40), np.array([0, 0, 7, 8, 30, 40])
    first, stop = line_dedup._windows(sizes, rows, 50)
    want = set()
    for a, b in zip(rows[:-1], rows[1:]):
        fit = [(i, j) for i in range(a, b) for j in range(i + 1, b + 1) if sizes[i:j].sum() >= 50]
        want |= {(i, j) for i, j in fit if (i, j - 1) not in fit or (i + 1, j) not in fit}
        want |= {(a, b)} if not fit and b > a else set()
    assert set(zip(first.tolist(), stop.tolist())) == want
    hashes = rng.integers(0, 9, 40).astype(np.uint64)
    assert textkit.least(hashes, first, stop).tolist() == [i + int(np.argmin(hashes[i:j])) for i, j in zip(first, stop)]
    twice = textkit.stretches(np.tile(hashes, 2), np.concatenate([first, first + 40]), np.concatenate([stop, stop + 40]))
    assert (twice[:len(first)] == twice[len(first):]).all()


def naive_tiles(item, text, least):
    """Words of the item under greedy tiles, by trying every length and place."""
    item, text, covered = list(item), list(text), 0
    for length in range(len(item), least - 1, -1):
        for i in range(len(item) - length + 1):
            for j in range(len(text) - length + 1):
                if None not in item[i:i + length] and item[i:i + length] == text[j:j + length]:
                    covered += length
                    item[i:i + length] = [None] * length
                    text[j:j + length] = [0] * length
                    break
    return covered


def test_tiles_equal_every_length_tried():
    rng = np.random.default_rng(11)
    for n in range(150):
        size, least = int(rng.integers(1, 6)) if n % 3 else 30, int(rng.integers(1, 6))
        item, text = (rng.integers(1, size + 1, int(rng.integers(1, 40))).astype(np.uint64) for _ in "ab")
        found = decontamination.tiles(item, text, least)
        assert sum(t[0] for t in found) == naive_tiles(item.tolist(), text.tolist(), least)
        assert all((item[i:i + k] == text[j:j + k]).all() and k >= least for k, i, j in found)
        places = [x for k, i, _ in found for x in range(i, i + k)], [x for k, _, j in found for x in range(j, j + k)]
        assert all(len(p) == len(set(p)) for p in places)


def test_tiles_of_very_long_texts():
    rng = np.random.default_rng(12)
    item = rng.integers(1, 51, 20_000).astype(np.uint64)
    moved = np.concatenate([item[12_000:], rng.integers(1, 51, 500).astype(np.uint64), item[:12_000]])
    for text, covered in ((moved, 20_000), (np.full(20_000, 3, np.uint64), 0), (item, 20_000)):
        start = time.perf_counter()
        found = decontamination.tiles(item, text, 5)
        assert sum(k for k, _, _ in found) >= covered and time.perf_counter() - start < 5
    same = np.full(20_000, 7, np.uint64)
    assert decontamination.tiles(same, same[:15_000], 5) == [(15_000, 0, 0)]


def alnum(text):
    return re.findall(r"[0-9a-z\x80-\U0010FFFF]+", low(text))


def test_decontamination(spark):
    rng = random.Random(2)
    items = [(i, prose(9000 + i, 30)) for i in range(6)] + [(6, "one two"), (7, None), (8, ""), (9, prose(9000, 30)), (None, prose(9100, 25))]
    rows = awkward()
    for n in range(40):
        words = alnum(rng.choice(items[:6])[1])
        cut = rng.randrange(4, 26)
        parts = [words[cut:], words[:cut]] if n % 2 else [words[:cut]]
        rows.append((300 + n, (prose(n, 40) + " " + ", ".join(" ".join(p) for p in parts) + ". " + prose(50 + n, 30)).title(), "a"))
    rows += [(400, "x one TWO y", "a"), (401, "one x two", "a"), (402, items[10][1], "a"), (403, items[0][1] * 3, "a")]
    documents_, benchmark = documents(spark, rows), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, coverage int")
    want = []
    for d, t, _ in rows:
        for i, item in items:
            words = alnum(item)
            if words:
                covered = naive_tiles(words, alnum(t), min(5, len(words)))
                if covered and covered >= 0.5 * len(words):
                    want.append((d, i, covered))
    got = decontamination.matches(documents_, benchmark).collect()
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.item_id, r.covered_words)) for r in got) and len(want) > 20
    clean = decontamination.clean(documents_, benchmark)
    bad = {w[0] for w in want}
    assert sorted(map(repr, (r.doc_id for r in clean.collect()))) == sorted(repr(d) for d, _, _ in rows if d not in bad)
    assert clean.columns == documents_.columns
    nothing = documents(spark, [])
    assert decontamination.matches(nothing, benchmark).count() == decontamination.matches(documents_, benchmark.limit(0)).count() == 0
    assert decontamination.clean(documents_, benchmark.limit(0)).count() == len(rows)


def test_decontamination_in_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(i, prose(i, 20)) for i in range(8)], "item_id long, text string")
    rows = documents(spark, [(i, prose(i, 20), "a") for i in range(12)])
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 300)
    assert sorted((r.doc_id, r.item_id) for r in decontamination.matches(rows, items).collect()) == [(i, i) for i in range(8)]


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return low(host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_url_filter(spark):
    rng = random.Random(8)
    urls = [f"http://{rng.choice(['Good', 'fine', 'x.nice'])}{i % 7}.ORG/en/{i}?a=b" for i in range(60)]
    urls += [f"https://bad{i % 5}.com/de/spam-{i}" for i in range(60)] + [f"https://bad{i % 5}.net/de/spam-{i}#t" for i in range(20)]
    urls += [f"http://fine{i % 7}.net/en/{i}" for i in range(20)]
    urls += [None, "", "no scheme", "http://", "x://EXAMPLE.org/es/1", "http://a.example.org/en/1x", "http://example.org/en/2", "http://org", "http://org/",
             "http://a.com?x=/fr/", "http://notexample.org/es/", "http://é.com/fr/ü", "http://a.org/x://b.com/de/", "a://b\nc.org/\n", "http://q.net/" + "z" * 50_000]
    pages = spark.createDataFrame([(None if i == 3 else i, u, "<p>", 1.0) for i, u in enumerate(urls)] + [(0, urls[0], "", 2.0)],
                                  "page_id long, url string, html string, s double")
    got = url_filter.judge(pages).collect()
    assert len(got) == len(urls) + 1
    by_id = {r.page_id: r for r in got}
    for i, url in enumerate(urls):
        if i != 3:
            host, path = split_url(url)
            rule, verdict = rule_of(host, path)
            r = by_id[i]
            assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block") and verdict in (None, r.verdict), url
    assert all(by_id[i].verdict == "block" for i in range(120, 140)) and all(by_id[i].verdict == "allow" for i in range(140, 160))


def test_url_scores_are_those_of_the_models(spark):
    """The table of grams against the models' definition, url by url."""
    import hashlib
    import math
    urls = [f"http://a{i}.org/k{i}" for i in range(12)] + [f"http://b{i}.com/de/{i}" for i in range(12)] + ["http://c.net/q", None]
    got = {r.page_id: r.score for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    rests = [u.split("://")[1] if u else "" for u in urls]
    grams = {r: [("\2" * 4 + r + "\3")[i:i + 5] for i in range(len(r) + 1)] for r in rests}
    symbols = len({g[4] for gs in grams.values() for g in gs})
    train = [[r for r in rests if (".org/" in r, ".com/de" in r)[side] and int(hashlib.md5(r.encode()).hexdigest()[:8], 16) % 5] for side in (0, 1)]

    def share(side, gram, order):
        if order < 0:
            return 1 / symbols
        own, context = gram[4 - order:], gram[4 - order:4]
        seen = [g for r in train[side] for g in grams[r]]
        c, n = sum(g.endswith(own) for g in seen), sum(g[:4].endswith(context) for g in seen)
        return (c + 2 * share(side, gram, order - 1)) / (n + 2)

    for i in (0, 13, 24, 25):
        want = [math.log(share(0, g, 4)) - math.log(share(1, g, 4)) for g in grams[rests[i]]]
        assert abs(got[i] - sum(want) / len(want)) < 1e-9


def test_url_filter_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_filter.judge(pages).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0)).count() == 0
