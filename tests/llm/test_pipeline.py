import hashlib
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from chronokey.llm import mixing, toxicity
from chronokey.llm.common import documents
from chronokey.llm.queries import byte_vocabulary

from .cases import SCHEMA, edge_documents, empty_documents
from .test_near import brute_classes

SF = "/root/testdata/sf0.001"


def brute(spark, sf_dir):
    """Rows left after each stage, on the driver; the toxicity model and the mix are the operators' own."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    bad = {r["doc_id"] for r in toxicity.toxicity(docs, labels).filter("predicted = 1").collect()}
    rows = [r for r in docs.collect() if r["doc_id"] not in bad]
    yield rows
    best = {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", r["text"])
        if key not in best or (-len(r["text"]), r["doc_id"]) < (-len(best[key]["text"]), best[key]["doc_id"]):
            best[key] = r
    rows = list(best.values())
    yield rows
    rows = [r for r, c in zip(rows, brute_classes(rows)) if c == r["doc_id"]]
    yield rows
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(rows, docs.schema)).collect()}
    rows = [r for r in rows for _ in range(plan[r["doc_id"]])]
    yield rows
    t = Tokenizer.from_file(byte_vocabulary())
    yield Counter((r["doc_id"], hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in t.encode(r["text"], add_special_tokens=False).ids)).hexdigest()) for r in rows)


def test_stages_equal_brute_force(spark):
    docs = documents(spark, SF)
    for (name, stage), want in zip(C.STAGES, brute(spark, SF), strict=True):
        out = stage(spark, docs, SF)
        rows = out.collect()
        if name == "bpe_encode":
            assert Counter((r["doc_id"], hashlib.sha256(r["ids"]).hexdigest()) for r in rows) == want
        else:
            assert out.columns == docs.columns
            assert Counter(rows) == Counter(want), name
            assert 0 < len(rows)
            docs = spark.createDataFrame(rows, docs.schema)
    assert C.run(spark, SF).count() == sum(want.values())


@pytest.mark.parametrize("make", [edge_documents, empty_documents])
def test_edge_tables_pass_all_stages(spark, make):
    docs = make(spark)
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF)
        if name != "bpe_encode":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), SCHEMA)
        else:
            assert out.count() == docs.count()
