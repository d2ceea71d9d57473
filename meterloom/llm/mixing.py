"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only.

Sources by code point, null last, weigh WEIGHTS in turn and share all words. A target stops at EPOCHS times its source's
words; the excess is shared again by weight until none is above (one pass over the sources in the order in which they
reach their limit).

The schedule has 2^m slots, so that a block has BLOCK words at most. Slot k is the point whose m bits are k's reversed
(van der Corput); points are mapped through the cumulative targets, so every run of slots holds each source near its
share, and all slots hold it exactly. A source's documents lie in the order of md5(SEED, doc_id), one after the other, in
blocks of equal words; its slots, ranked, take its blocks in turn, beginning anew when the source is used up. The last
block is cut where the target, rounded to a word, is reached; so a document is taken EPOCHS times at most.

Offsets are running sums by ranges, so a source with a third of all rows is spread. Reruns give the same rows.

Null and wordless texts have size 0 and nothing taken; a null doc_id sorts first and keeps its row; rows that repeat are
taken one by one, in any order among themselves; a source without words has target 0. An empty table gives an empty one.
Extra columns are ignored by `taken` and carried by `mixed`."""

from pyspark.sql import DataFrame, functions as F

from meterloom.llm.running import running
from meterloom.session import settle

WEIGHTS = (5, 2, 1)
EPOCHS = 3
BLOCK = 256
SEED = "mix-1/"
_WORD = r"[^\x20\x09-\x0D]+"


def sized(documents: DataFrame) -> DataFrame:
    """doc_id, source, its non-null key `s`, size in words, and the shuffle key `k`."""
    return settle(documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("s"),
        F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("k")), "sizes")


def targets(rows: DataFrame) -> DataFrame:
    """Per source: s, source_size, target, and the words it gives, `whole`. rows: those of `sized`."""
    sources = rows.groupBy("s").agg(F.first("source").alias("source"), F.sum("size").alias("source_size")).withColumn("one", F.lit(1))
    ranked = running(sources, [F.col("source").asc_nulls_last()], "one", name="sources")
    # As a long: a weight times the words of all sources passes an int.
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("one_before") % len(WEIGHTS) + 1).cast("int")).cast("long")
    weighed = ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * EPOCHS)
    order = [(F.col("limit") / F.col("weight")), F.col("s")]
    filled = running(running(weighed, order, "limit", name="limits"), order, "weight", name="weights")
    exact = "decimal(38,0)"
    words, weights = filled.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    stopped = filled.withColumn("full", F.col("limit").cast(exact) * (F.lit(weights) - F.col("weight_before")) <=
                                F.col("weight").cast(exact) * (F.lit(words) - F.col("limit_before")))
    given, shared = stopped.agg(F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))), F.lit(0)),
                                F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0))).first()
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(
        (F.col("weight") * F.lit(words - given)).cast("double") / F.lit(max(shared, 1)))
    return stopped.select("s", "source_size", target.alias("target")).withColumn("whole", F.floor(F.col("target") + 0.5).cast("long"))


def schedule(sources: DataFrame) -> DataFrame:
    """(s, rank, slot, block): the slots of each source in order, and the words of its blocks. sources: `targets`."""
    given = sources.where("whole > 0")
    total = given.agg(F.sum("whole").alias("n")).first().n or 0
    bits = max(0, -(-total // BLOCK) - 1).bit_length()
    points = 1 << bits
    spans = running(given, [F.col("s")], "whole", name="spans").select(
        "s", "whole", F.expr(f"cast(floor(cast(whole_before as decimal(38,0)) * {points} / {max(total, 1)}) as long)").alias("low"),
        F.expr(f"cast(floor(cast(whole_before + whole as decimal(38,0)) * {points} / {max(total, 1)}) as long)").alias("high"))
    spans = spans.withColumn("high", F.greatest("high", F.col("low") + 1)).withColumn(
        "block", F.ceil(F.col("whole") / (F.col("high") - F.col("low"))).cast("long"))
    parts = spans.withColumn("part", F.explode(F.expr("sequence(low, high - 1, 4096L)"))).repartition("s", "part")
    slots = parts.select("s", "block", F.explode(F.expr("sequence(part, least(part + 4095, high - 1))")).alias("point"), F.lit(1).alias("one"))
    reversed_bits = F.conv(F.reverse(F.lpad(F.bin("point"), max(bits, 1), "0")), 2, 10).cast("long")
    return running(slots.withColumn("slot", reversed_bits), [F.col("slot")], "one", ["s"], "slots").select(
        "s", F.col("one_before").alias("rank"), "slot", "block")


def pieces(rows: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pieces, laid). laid: rows with words and the place `at` where each begins in its source. pieces: s, at, slot,
    first, n; the slot takes n words of the document at that place, from word `first` on."""
    laid = running(rows.where("size > 0"), [F.col("k"), F.col("doc_id"), F.col("size")], "size", ["s"], "laid").withColumnRenamed("size_before", "at")
    laid = settle(laid, "laid-out")
    slots = settle(schedule(sources), "schedule")
    blocks = sources.where("whole > 0").join(slots.select("s", "block").distinct(), "s").select("s", "source_size", "whole", "block")
    runs = (laid.join(blocks, "s").withColumn("epoch", F.explode(F.expr(f"sequence(0L, {EPOCHS - 1}L)")))
            .withColumn("low", F.col("at") + F.col("epoch") * F.col("source_size"))
            .withColumn("high", F.least(F.col("low") + F.col("size"), F.col("whole"))).where("low < high"))
    parts = runs.withColumn("rank", F.explode(F.expr("sequence(low div block, (high - 1) div block)"))).select(
        "s", "at", "rank", F.greatest(F.col("low"), F.col("rank") * F.col("block")).alias("from"), "low",
        F.least(F.col("high"), (F.col("rank") + 1) * F.col("block")).alias("to"))
    return parts.join(slots.select("s", "rank", "slot"), ["s", "rank"]).select(
        "s", "at", "slot", (F.col("from") - F.col("low")).alias("first"), (F.col("to") - F.col("from")).alias("n")), laid


def taken(documents: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target and taken for every row of documents; see the module for each case."""
    rows = sized(documents)
    sources = settle(targets(rows), "targets")
    parts, laid = pieces(rows, sources)
    sums = parts.groupBy("s", "at").agg(F.sum("n").alias("taken"))
    used = laid.join(sums, ["s", "at"], "left").select("doc_id", "source", "s", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    unused = rows.where("size = 0").select("doc_id", "source", "s", "size", F.lit(0).cast("long").alias("taken"))
    return used.unionByName(unused).join(sources, "s").select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed(documents: DataFrame) -> DataFrame:
    """The mix as documents, all columns: a row for each time a document is taken. The last time may take only its first
    words, joined by spaces; `n_chars` then follows. Documents of which nothing is taken are not in it."""
    counts = taken(documents).where("taken > 0").groupBy("doc_id", "source", "size").agg(F.sum("taken").alias("taken"), F.count("*").alias("rows"))
    counts = counts.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"),
                           (F.col("taken") / F.col("rows")).cast("long").alias("_taken"))
    own = documents.withColumn("_n", F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long"))
    found = own.join(counts, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_n") == F.col("_size")))
    times = found.withColumn("_left", F.explode(F.expr("transform(sequence(1L, (_taken + _n - 1) div _n), i -> least(_n, _taken - (i - 1) * _n))")))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)), F.lit(1), F.col("_left").cast("int")), " ")
    text = F.when(F.col("_left") < F.col("_n"), cut).otherwise(F.col("text"))
    picked = {"text": text.alias("text")}
    if "n_chars" in documents.columns:
        picked["n_chars"] = F.when(F.col("_left") < F.col("_n"), F.length(cut).cast(documents.schema["n_chars"].dataType)).otherwise(
            F.col("n_chars")).alias("n_chars")
    return times.select(*[picked.get(c, F.col(f"`{c}`")) for c in documents.columns])
