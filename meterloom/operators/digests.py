"""Comparing stores by digests: rows are joined only where two stores differ.

Each store is folded to a digest per bucket of its keys: the number of rows and order-free sums of two 64-bit hashes of
each row, with the place of every null. The fold is a partial aggregate, so no row is shuffled. Buckets whose digests differ
are folded once more, each into FINE smaller ones, and only rows of smaller ones that differ are compared by key. Two equal
stores end without a row; one changed row brings the rows of one smaller bucket, one in COARSE * FINE of a group.

`group` names columns that cut a store before its keys do, such as its day and machine: where they partition the stored
files, the second fold and the comparison open only the folders from the first to the last value that differs. A key whose group changed differs in
both groups' buckets, so it still meets itself. Rows without a key, and keys that repeat, count in digests as any row does;
where digests are equal they are the same."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from meterloom.operators.reconcile import compare_facts, missing_from
from meterloom.session import settle

COARSE = 256
FINE = 256


def _cell(key: str, n: int, level: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level), F.col(key)), F.lit(n))


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def digests(rows: DataFrame, group: Sequence[str], key: str, values: Sequence[str], cells: dict[str, Column]) -> DataFrame:
    """One row per group and cell: n, and digest, equal for equal sets of rows in whatever order."""
    sums = []
    for seed in (1, 2):  # halves of hashes, so that no sum overflows below 2^31 rows
        h = _row_hash([key, *values], seed)
        sums += [F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(h, 32))]
    return rows.groupBy(*group, *[c.alias(name) for name, c in cells.items()]).agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("digest"))


def _unequal(a: DataFrame, b: DataFrame, names: Sequence[str]) -> DataFrame:
    """The groups and cells whose digests differ, or that one side lacks."""
    sides = a.select(*names, "n", "digest").unionByName(b.select(*names, "n", "digest").withColumn("n", -F.col("n")))
    return sides.groupBy(*names).agg(F.sum("n").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"),
                                     F.count(F.lit(1)).alias("sides")).where("n <> 0 OR low <> high OR sides <> 2").select(*names)


def _within(rows: DataFrame, cells: dict[str, Column], group: Sequence[str], wanted: DataFrame) -> DataFrame:
    if group:
        ends = wanted.agg(*[f(c).alias(f"{name}_{c}") for c in group for name, f in (("low", F.min), ("high", F.max))]).first()
        for c in group:
            rows = rows.where(F.col(c).isNull() | F.col(c).between(F.lit(ends[f"low_{c}"]), F.lit(ends[f"high_{c}"])))
    named = wanted.select([F.col(c).alias(f"_wanted_{c}") for c in wanted.columns])
    fits = [F.col(c).eqNullSafe(F.col(f"_wanted_{c}")) for c in group] + [e == F.col(f"_wanted_{name}") for name, e in cells.items()]
    found = fits[0]
    for fit in fits[1:]:
        found = found & fit
    return rows.join(named, found, "left_semi")


def narrowed(a: DataFrame, b: DataFrame, values: Sequence[str], key: str, group: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, int]:
    """The rows of both stores in the smallest buckets that differ, and how many rows a holds in all."""
    coarse = {"_coarse": _cell(key, COARSE, 1)}
    fine = {**coarse, "_fine": _cell(key, FINE, 2)}
    first = settle(digests(a, group, key, values, coarse), "digests")
    unequal = settle(_unequal(first, digests(b, group, key, values, coarse), [*group, *coarse]), "unequal")
    total = first.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if unequal.isEmpty():
        return a.limit(0), b.limit(0), total
    near = [_within(x, coarse, group, unequal) for x in (a, b)]
    smaller = settle(_unequal(*(digests(x, group, key, values, fine) for x in near), [*group, *fine]), "unequal")
    return _within(a, fine, group, smaller), _within(b, fine, group, smaller), total


def compare_stores(old: DataFrame, new: DataFrame, values: Sequence[str], key: str = "request_id", group: Sequence[str] = ()) -> DataFrame:
    """One row: old_rows, and how many of them the new store misses or holds with other values."""
    a, b, total = narrowed(old, new, values, key, group)
    return compare_facts(a, b, list(values), key).agg(
        F.lit(total).cast("long").alias("old_rows"), F.count_if(F.col("state") == "missing").alias("missing"),
        F.count_if(F.col("state") == "different").alias("different"))


def missing(source: DataFrame, target: DataFrame, key: str = "row_hash", group: Sequence[str] = ()) -> DataFrame:
    """The rows of source whose key target lacks; those of equal buckets are not looked up."""
    a, b, _ = narrowed(source, target, [], key, group)
    return missing_from(a, b, key)
