"""One thin query per operator, over whole tables, with the parameters a production run takes, and the SQL for those that
SQL can express."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from meterloom.llm import caps, decontamination, license_scan, line_dedup, lm_scoring, merkle, mixing, ngram_join, periodic, token_store, topk_search, toxicity, url_filter
from meterloom.llm.oracle import ORACLE
from meterloom.session import configure, scratch, settle
from meterloom.sources.lines import computed

__all__ = ["ORACLE", "QUERIES"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(configure(spark), sf_dir)
    QUERIES[f.__name__] = run
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_ids(documents: DataFrame) -> DataFrame:
    """Writes the documents' token ids to the shared folder and reads their digests back."""
    spark = documents.sparkSession
    folder = scratch(spark, "token-ids")
    manifest = settle(token_store.write(documents, folder, TOKENIZER), "token-shards")
    return token_store.digests(spark, folder, manifest)


@query
def op1_exact_topk_search(spark, sf_dir):
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query
def op2_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op3_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op4_source_mixing(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op6_token_ids(spark, sf_dir):
    return token_ids(table(spark, sf_dir, "documents"))


@query
def op7_toxicity(spark, sf_dir):
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_benchmark_decontamination(spark, sf_dir):
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_line_dedup(spark, sf_dir):
    return line_dedup.clean(table(spark, sf_dir, "documents"), line_dedup.WORDS).select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query
def op10_lm_scoring(spark, sf_dir):
    return lm_scoring.score(table(spark, sf_dir, "documents"))


@query
def op11_merkle_manifest(spark, sf_dir):
    """Where 5 divides the key's checksum, the text is read with its A-Z lower-cased."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.audit(table(spark, sf_dir, "documents"), {"text": F.when(hit, lower).otherwise(F.col("text"))})


@query
def op12_embedding_near_dedup(spark, sf_dir):
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"))


def planted(documents: DataFrame) -> DataFrame:
    """doc_id and text; where 10 divides the key's checksum, the words from some place on repeat with some period."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size("_w")
    split = computed(documents.select("doc_id", "text", h.alias("_h"), g.alias("_g")), _w=F.when(F.col("_h") % 10 == 0, words))
    placed = split.withColumn("_n", n).withColumn("_a", F.col("_g") % F.col("_n")).withColumn(
        "_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
    told = F.transform("_w", lambda w, i: F.when(i < F.col("_a"), w).otherwise(
        F.get("_w", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))))
    return placed.select("doc_id", F.when(F.col("_n") > 0, F.array_join(told, " ")).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark, sf_dir):
    """The run of the largest exact length / period is found by cross-multiplication."""
    def order(a, b):
        less = a["length"] * b["period"] - b["length"] * a["period"]
        return (F.when(less != 0, -F.signum(less)).when(a["start"] != b["start"], F.signum(a["start"] - b["start"]))
                .otherwise(F.signum(a["period"] - b["period"]))).cast("int")
    found = periodic.runs(planted(table(spark, sf_dir, "documents")))
    best = computed(found, best=F.get(F.array_sort("runs", order), F.lit(0)))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    b = lambda c: F.col(f"best.{c}")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), b("start").alias("start"), b("length").alias("length"), b("period").alias("period"),
        F.floor(1000 * b("length") / b("period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
