"""Small documents with every awkward case, and plain Python forms of what the operators compute."""

import random

LOWER = bytes(range(256)).translate(bytes(x + 32 if 65 <= x < 91 else x for x in range(256)))
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n int, h long, word string, s string, x long, size int, "
          "component string, rep long, lines int, row int, lead int")


def fold(text):
    """The words of a text that white space parts, A-Z lower-cased."""
    return (text or "").encode().translate(LOWER).split()


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), 1, 2, "w", "s", 3, 4, "c", 5, 6, 7, 8)


def documents(spark, rows):
    return spark.createDataFrame([row(*r) for r in rows], SCHEMA)


def prose(seed, words=60, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def awkward():
    """(doc_id, text, source): nulls, empty and wordless texts, repeats, copies, near copies, a very long text."""
    base = prose(1, 80)
    words = base.split()
    near = [" ".join(words[:i] + ["changed%d" % i] + words[i + 1:]) for i in (10, 40, 70)]
    far = " ".join(w + "x" if i % 3 == 0 else w for i, w in enumerate(words))
    return [(7, base, "a"), (3, base.upper(), "a"), (9, near[0], "b"), (11, near[1], None), (12, near[2], "b"), (20, far, "c"),
            (21, prose(2), "c"), (22, prose(2), "c"), (22, prose(2), "c"), (30, None, "a"), (31, "", "a"), (32, " \n\t ", "b"),
            (None, prose(3), None), (None, None, None), (40, "a b", "c"), (41, "A  B", "c"), (42, "a b c d e", "d"),
            (50, prose(4, 20_000, 3_000), "a"), (51, "é È naïve \x0b ünï", "e")]
