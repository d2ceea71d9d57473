"""The registered queries beside DuckDB, and the pipeline's stages beside brute force, at the smallest scale."""

import zlib

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from compare import compare, connect
from meterloom.llm import decontamination, toxicity
from meterloom.llm.queries import ORACLE, QUERIES
from test_joins_and_search import expected
from test_models_and_output import size, targets

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), QUERIES[name], ORACLE[name], SF) == ""


def test_pipeline(spark):
    """Each stage on what the one before kept."""
    from tokenizers import Tokenizer
    docs, previous = spark.read.parquet(f"{SF}/documents.parquet"), None
    stages = dict(corpus_pipeline.STAGES)
    kept = {}
    for name, stage in list(stages.items())[:4]:
        previous, out = docs, stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept[name] = (previous.collect(), docs.collect())
    before, after = kept["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.scores(spark.read.parquet(f"{SF}/documents.parquet"), labels).collect() if r.predicted}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - toxic
    before, after = kept["n-gram Jaccard join"]
    components = expected([(r.doc_id, r.text, r.source) for r in before])
    assert {r.doc_id for r in after} == {d for d, c in components.items() if d == c} and len(after) == len({r.doc_id for r in after})
    before, after = kept["benchmark decontamination"]
    bad = {r.doc_id for r in decontamination.matches(spark.createDataFrame(before), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - bad
    before, after = kept["mixing sources to target weights"]
    _, target = targets([(r.doc_id, r.text, r.source) for r in before])
    for source, wanted in target.items():
        assert abs(sum(size(r.text) for r in after if r.source == source) - wanted) <= 0.5
    ids = stages["token-ID / binary output"](spark, docs, SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = [tokenizer.encode(r.text, add_special_tokens=False).ids + [2] for r in after]
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in ids) == sorted(
        (r.doc_id, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for r, x in zip(after, own))
