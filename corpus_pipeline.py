"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, documents that hold benchmark
items go, sources are mixed to their weights, and the mix becomes token ids with an index.

A stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. `run` writes each stage's rows as
Parquet to the shared folder and reads them as the next one's documents."""

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from meterloom.llm import decontamination, mixing, ngram_join, toxicity
from meterloom.llm.queries import table, token_ids
from meterloom.session import configure, settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go. The model learns from the labels of the documents at hand."""
    return toxicity.clean(docs, table(configure(spark), sf_dir, "labels"))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.75 or more, the one with the smallest doc_id stays."""
    configure(spark)
    return ngram_join.representatives(docs, 5, Fraction(3, 4))


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item's words or more, in passages of five words or more, go."""
    return decontamination.clean(docs, table(configure(spark), sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document."""
    configure(spark)
    return mixing.mixed(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of the mix, read back from the shards."""
    configure(spark)
    return token_ids(docs)


STAGES = [("toxicity", drop_toxic), ("n-gram Jaccard join", keep_one_of_near_duplicates), ("benchmark decontamination", drop_benchmark_copies),
          ("mixing sources to target weights", mix_sources), ("token-ID / binary output", write_token_ids)]

#: Toxicity's trained model and the tokenizer are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), "stage-" + name.split()[0].replace("/", "-"))
    return docs
