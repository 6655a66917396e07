"""The pipeline's stages against plain rules, each on its own input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spark_curate.llm import queries, toxicity

from .conftest import prose
from .test_tables import plain_components, plain_fingerprint
from .test_texts import check_packing, labelled, plain_counts, plain_verdict


@pytest.fixture(scope="module")
def folder(make, spark, awkward, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    docs, labels = labelled(200)
    copies = [(700 + k, docs[7][1]) for k in range(5)] + [(800, prose(5, 100) + " end"), (801, prose(5, 100) + " end ")]
    repeats = [(900, "buy now\n" * 90)]
    awkward = [(i + 5000 if i else None, t) for i, t in awkward]
    make(docs + copies + repeats + awkward).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_and_the_whole(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, inputs = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        inputs.append((name, docs))
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert docs.columns == columns
    outputs = [d for _, d in inputs[1:]]
    read = lambda df: Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())

    # toxicity: what the operator predicts on the same rows, and no labelled clean document lost
    before, after = read(inputs[0][1]), read(outputs[0])
    model = toxicity.fit(inputs[0][1], spark.read.parquet(f"{folder}/labels.parquet"))
    toxic = Counter((r.doc_id, r.text) for r in inputs[0][1].join(toxicity.score(inputs[0][1], model).where("predicted = 1").select("doc_id").distinct(), "doc_id").collect())
    assert before - after == toxic and len(toxic) >= 45
    assert {i for i, _ in before - after} <= {k for k in range(200) if k % 4 == 0}

    # quality
    keeps = lambda t: not plain_counts(t)["base_failed"] and plain_verdict(t) == "keep"
    assert read(outputs[1]) == Counter({k: n for k, n in after.items() if keeps(k[1])})
    assert 900 not in {i for i, _ in read(outputs[1])}

    # near-duplicates
    rows = sorted(read(outputs[1]).elements(), key=lambda x: (x[0] is None, x[0] or 0))
    roots = plain_components([plain_fingerprint(t) for _, t in rows], 4)
    want = Counter(rows[k] for k in {r: k for k, r in reversed(list(enumerate(roots)))}.values())
    assert read(outputs[2]) == want and len(rows) > len(set(roots))

    # packing, and run() as a whole
    packed = [r.asDict() for r in docs.collect()]
    check_packing(packed, list(want.elements()))
    whole = corpus_pipeline.run(spark, folder)
    assert whole.columns == docs.columns
    slim = lambda df: Counter(df.select("doc_id", "piece", "ids_crc32").collect())
    assert slim(whole) == slim(docs)


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where(F.lit(False))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() == 0


def test_registered_queries():
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in queries.QUERIES)] == []
    assert "pipeline" in queries.QUERIES and queries.SQL.keys() <= queries.QUERIES.keys()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "simhash_dedup", "packing"]
