"""The pipeline's stages on whole tables, and its awkward inputs."""

import corpus_pipeline
from linkloom.llm import decontaminate, lattice, pii, simhash
from linkloom.llm.frames import stored


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (-5, "", "en", "s", 0), (-5, "", "en", "s", 0)], docs.schema)
    now = docs.unionByName(odd)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        now = out[name] = stored(stage(spark, now, sf_dir))
        if name != "tokens":
            assert now.columns == docs.columns
    judged = out["quality"].join(labels, "doc_id")
    assert judged.where("quality = 1").count() == docs.join(labels, "doc_id").where("quality = 1").count()
    found = simhash.near_duplicates(out["near_duplicates"])
    assert found.select("component_id").distinct().count() == found.count()
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert decontaminate.contamination_report(out["decontamination"], bench).where("contaminated").count() == 0
    left = pii.personal_data(out["personal_data"])
    assert left.where("n_email + n_ip + n_card + n_phone > 0").count() == 0
    tokens = out["tokens"]
    assert tokens.count() == out["personal_data"].count() and tokens.where("NOT round_trip").count() == 0
    assert tokens.join(out["personal_data"], "doc_id").count() == tokens.where("doc_id IS NOT NULL").count()
    assert lattice.encoded(docs.limit(0)).columns == tokens.columns
