"""URL filters: rules, and a character language-model ratio where no rule fits; DataFrame functions only.

Rules judge the urls they fit. These judged urls train two smoothed variable-order Markov models over characters, one of
accepted and one of rejected urls: the next character's share after a context of ORDER characters, mixed with that after
the context one character shorter by SMOOTH imagined counts, down to single characters and an even share; a context a class
never showed adds nothing, so its order is as long as the class knows it. A url's score is the sum over its characters of
the difference of both log shares, divided by their number. The threshold is calibrated on one in FOLDS judged urls (by
md5), which the models do not see: the score, in steps of STEP, that tells most of both classes apart; the nearest to 0
among equals. A url no rule fits is allowed from the threshold on.

The part after `://` is scored, from a start mark to an end mark. Equal urls are counted before they are cut up. Counts
are kept per gram of ORDER + 1 characters, so the models are a table of distinct grams; it is broadcast only if it has at
most BROADCAST_GRAMS rows, and joined otherwise.

A null url, or one without `://`, has an empty host and path and is judged as an empty text. Null page_ids and repeated
rows keep their rows. If no url of either class is left to train with, every url without a rule is allowed (blocked, if all
judged urls are). An empty table gives an empty one; extra columns are ignored."""

from pyspark.sql import Column, DataFrame, functions as F

from meterloom.session import settle

ORDER = 4
SMOOTH = 2.0
FOLDS = 5
STEP = 0.01
BROADCAST_GRAMS = 300_000
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
         ("block", "com", "/de/")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rule(rules: list[tuple[str, str, str]], pick) -> Column:
    """What `pick` makes of the longest rule that fits host and path."""
    out = None
    for rule in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == rule[1]) | F.col("host").endswith("." + rule[1])) & F.col("path").startswith(rule[2])
        out = F.when(fits, F.lit(pick(rule))) if out is None else out.when(fits, F.lit(pick(rule)))
    return out


def judged(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """page_id, rest, host, path, rule, ruled: the verdict of the rule. rest: what follows `://`, its host lower-cased."""
    at = F.instr("url", "://")
    after = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    parts = pages.select("page_id", F.coalesce(after, F.lit("")).alias("after")).select(
        "page_id", F.translate(F.regexp_extract("after", r"^[^/?#]*", 0), _UPPER, _LOWER).alias("host"),
        F.regexp_extract("after", r"^[^/?#]*([^?#]*)", 1).alias("path"), F.regexp_extract("after", r"(?s)^[^/?#]*(.*)$", 1).alias("tail"))
    return parts.select("page_id", F.concat("host", "tail").alias("rest"), "host", "path",
                        _rule(rules, lambda r: r[1] + r[2]).alias("rule"), _rule(rules, lambda r: r[0]).alias("ruled"))


def _grams(urls: DataFrame) -> DataFrame:
    """The grams of every url: ORDER characters of context and the next one, after ORDER start marks and to an end mark."""
    marked = F.concat(F.lit("\u0002" * ORDER), "rest", F.lit("\u0003"))
    chars = urls.withColumn("c", F.regexp_extract_all(marked, F.lit("(?s)."), F.lit(0)))
    cut = F.transform(F.sequence(F.lit(1), F.size("c") - ORDER), lambda i: F.array_join(F.slice("c", i, ORDER + 1), ""))
    return chars.withColumn("n", F.size("c") - ORDER).withColumn("gram", F.explode(cut)).drop("c", "rest")


def model(counts: DataFrame, sizes: tuple[int, int], symbols: int) -> DataFrame:
    """gram, s: what the gram adds to a url's score. counts: gram and its counts a (accepted) and b (rejected)."""
    def part(order: int, symbol: bool):
        return F.substring("gram", ORDER + 1 - order, order + symbol)

    def sums(order: int, symbol: bool) -> DataFrame:
        key = f"{'o' if symbol else 'c'}{order}"
        return counts.groupBy(part(order, symbol).alias(key)).agg(F.sum("a").alias(key + "a"), F.sum("b").alias(key + "b"))

    table, shares = counts, {"a": F.lit(1.0 / symbols), "b": F.lit(1.0 / symbols)}
    for order in range(ORDER + 1):
        for symbol in (True, False) if order else (True,):
            key = f"{'o' if symbol else 'c'}{order}"
            table = table.withColumn(key, part(order, symbol)).join(sums(order, symbol), key).drop(key)
    for order in range(ORDER + 1):
        for side, total in zip("ab", sizes):
            seen = F.col(f"c{order}{side}") if order else F.lit(total)
            shares[side] = (F.col(f"o{order}{side}") + SMOOTH * shares[side]) / (seen + SMOOTH)
    table = table.withColumns({"pa": shares["a"], "pb": shares["b"]})
    return table.select("gram", (F.ln("pa") - F.ln("pb")).alias("s"))


def _threshold(scored: DataFrame) -> float:
    """The score from which on a url is accepted, by balanced accuracy on the fold kept back. scored: s, a, b; a and b
    count its accepted and rejected urls. One row per STEP reaches the driver."""
    bins = scored.groupBy(F.floor(F.col("s") / STEP).cast("long").alias("bin")).agg(F.sum("a").alias("a"), F.sum("b").alias("b")).orderBy("bin").collect()
    all_a, all_b = sum(r.a for r in bins), sum(r.b for r in bins)
    if not all_a or not all_b:
        return 0.0
    best, below_a, below_b = (all_a / all_a, 0.0, bins[0].bin), 0, 0
    options = []
    for row in bins:
        options.append(((all_a - below_a) / all_a + below_b / all_b, -abs(row.bin), row.bin))
        below_a, below_b = below_a + row.a, below_b + row.b
    best = max(options)
    # The middle of the gap below it, if no url of the fold scores there.
    lower = [row.bin for row in bins if row.bin < best[2]]
    return (best[2] + (lower[-1] + 1 if lower else best[2])) / 2 * STEP


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score for every row of pages; see the module for each case."""
    rows = judged(pages, rules)
    held = F.conv(F.substring(F.md5("rest"), 1, 8), 16, 10).cast("long") % FOLDS == 0
    urls = settle(rows.groupBy("rest").agg(
        F.count_if((F.col("ruled") == "allow") & ~held).alias("a"), F.count_if((F.col("ruled") == "block") & ~held).alias("b"),
        F.count_if((F.col("ruled") == "allow") & held).alias("held_a"), F.count_if((F.col("ruled") == "block") & held).alias("held_b"))
        .withColumns({"u": F.xxhash64("rest"), "v": F.xxhash64(F.concat(F.lit("~"), "rest"))}), "urls")
    grams = _grams(urls)
    counts = settle(grams.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "grams")
    size_a, size_b, n = counts.agg(F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0)), F.count("*")).first()
    answer = rows.select("page_id", "rest", "host", "path", "rule", "ruled")
    if not size_a or not size_b:
        return answer.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("block" if size_b else "allow")).alias("verdict"),
                             F.lit(None).cast("double").alias("score"))
    symbols = counts.select(F.substring("gram", ORDER + 1, 1)).distinct().count()
    adds = settle(model(counts, (size_a, size_b), symbols), "model")
    if n <= BROADCAST_GRAMS:
        adds = F.broadcast(adds)
    scored = settle(grams.join(adds, "gram").groupBy("u", "v", "n", "held_a", "held_b").agg(F.sum("s").alias("s"))
                    .withColumn("s", F.col("s") / F.col("n")), "scored")
    from_on = _threshold(scored.where("held_a + held_b > 0").select("s", F.col("held_a").alias("a"), F.col("held_b").alias("b")))
    by_url = scored.select("u", "v", "s")
    return answer.withColumns({"u": F.xxhash64("rest"), "v": F.xxhash64(F.concat(F.lit("~"), "rest"))}).join(by_url, ["u", "v"]).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("s") >= from_on, "allow").otherwise("block")).alias("verdict"), F.col("s").alias("score"))
