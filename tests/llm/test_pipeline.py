"""The pipeline on a small table, stage by stage, against what was planted."""

import corpus_pipeline
from ledgerloom.llm.common import stored


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, n = docs.columns, docs.count()
    insults = "idiot stupid moron scum"
    planted = spark.createDataFrame(
        [
            (10_001, "alpha beta gamma delta " * 30 + "write to jane.roe@corp.example or 10.1.2.3", "en", "s", 1), (10_002, "Alpha beta gamma delta " * 30 + "write to jane.roe@corp.example or 10.1.2.3", "en", "s", 1),
            (10_003, spark.read.parquet(f"{sf}/benchmark.parquet").first()["text"], "en", "s", 1), (10_004, f"what {insults} people", "en", "s", 1), (10_005, None, None, None, None),
        ],
        docs.schema,
    )
    docs = docs.unionByName(planted)
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stored(stage(spark, docs, sf), f"test-{name}")
        assert docs.columns == columns
        kept = {r["doc_id"]: r["text"] for r in docs.where("doc_id > 10000").collect()}
        if name == "near_copies":
            assert (10_001 in kept) and (10_002 not in kept)
        if name == "decontamination":
            assert 10_003 not in kept
        if name == "private_data":
            assert "jane.roe" not in kept[10_001] and "10.1.2.3" not in kept[10_001] and 10_005 in kept
    assert docs.count() > n * 0.7
    packed = corpus_pipeline.STAGES[4][1](spark, docs, sf)
    whole = packed.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert len(whole) == docs.count() and all(r[1] == r[2] for r in whole)
