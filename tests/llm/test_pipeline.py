"""The corpus pipeline and the registered queries."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract
import corpus_pipeline
from brute import covered_parts, near_duplicate_classes, suffix_digests, word_digests
from layerloom.llm import packing, registry, toxicity
from layerloom.llm.common import read
from oracle import connect, differences
from test_tokens import check_packing, expected_pieces

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    ours = contract.queries()[name](spark, SF_DIR).toArrow()
    assert differences(ours, connect(SF_DIR).sql(contract.oracle_sql()[name]).to_arrow_table()) == []


def documents(spark):
    return [(r.doc_id, r.text) for r in read(spark, SF_DIR, "documents").select("doc_id", "text").collect()]


def test_op2_equals_brute_force(spark):
    found = {r.doc_id: r.class_id for r in contract.queries()["op2_minhash_near_dedup"](spark, SF_DIR).collect()}
    assert found == near_duplicate_classes(documents(spark))


def test_op4_equals_brute_force(spark):
    found = contract.queries()["op4_suffix_array_dedup"](spark, SF_DIR).collect()
    assert sorted(tuple(r) for r in found) == sorted(suffix_digests(documents(spark), 400))


def test_op9_equals_brute_force(spark):
    found = contract.queries()["op9_recompression_dedup"](spark, SF_DIR).collect()
    assert sorted(tuple(r) for r in found) == sorted(word_digests(documents(spark), 35))


def test_op1_and_op10_run_over_every_document(spark):
    found = contract.queries()["op1_best_fit_packing"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found} == expected_pieces(documents(spark))
    check_packing(found)
    assert contract.queries()["op10_bpe_round_trip"](spark, SF_DIR).count() == len(documents(spark))


def test_pipeline_equals_its_stages_done_plainly(spark):
    texts = dict(documents(spark))
    labels = read(spark, SF_DIR, "labels")
    rejected = {r.doc_id for r in toxicity.toxicity(read(spark, SF_DIR, "documents"), labels).collect() if r.predicted}
    left = [(i, t) for i, t in sorted(texts.items()) if i not in rejected]
    classes = near_duplicate_classes(left)
    left = [(i, t) for i, t in left if classes[i] == i]
    data = [t.encode() for _, t in left]
    left = [(i, bytes(b for b, c in zip(d, cover) if not c).decode("utf-8", "ignore")) for (i, _), d, cover in zip(left, data, covered_parts(data, 400))]
    found = contract.queries()["pipeline"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found} == expected_pieces(left)
    check_packing(found)


def test_stages_take_dirty_documents(spark):
    data = [(1, "a b c", "en", None, 5), (None, None, None, None, None), (2, "", "de", "s", 0), (1, "a b c", "en", None, 5), (3, "x " * 9000, "en", "s", 18000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({"score": F.lit(1), "bucket": F.lit(2), "ranges": F.lit("r"), "text_key": F.lit("k")})
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, frame, SF_DIR)
            assert found.columns == docs.columns, name
            assert found.count() <= frame.count()
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF_DIR).count() >= frame.count()


def test_registered_names():
    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    assert packing.SEQUENCE == 1024
