import hashlib

import pytest

import corpus_pipeline
from feedweave.llm import bpe, catalog, mixing, simhash, toxicity
from test_simhash import brute_groups, brute_print

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents after every stage, in the order in which they were written."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        kept.append(docs.collect())
    return kept


def test_stages_keep_the_columns(spark, stages):
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    assert all(list(rows[0].asDict()) == columns for rows in stages[:4])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "source_mixing", "byte_bpe"]


def test_toxic_documents_go(spark, stages):
    docs = spark.createDataFrame(stages[0])
    model = toxicity.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    score = {r["doc_id"]: r["score"] for r in toxicity.with_score(docs, model).collect()}
    assert sorted(r["doc_id"] for r in stages[1]) == sorted(i for i, s in score.items() if s < toxicity.THRESHOLD)


def test_one_of_each_group_stays(stages):
    groups = brute_groups([(r["doc_id"], brute_print(r["text"], catalog.SHINGLE_WORDS)) for r in stages[1]], catalog.BIT_DISTANCE)
    assert sorted(r["doc_id"] for r in stages[2]) == sorted({c for _, _, c in groups})


def test_mix_keeps_all_in_order(spark, stages):
    assert sorted(r["doc_id"] for r in stages[3]) == sorted(r["doc_id"] for r in stages[2])
    mixed = mixing.mix(spark.createDataFrame(stages[2]), catalog.TARGET_WEIGHTS, catalog.OTHER_WEIGHT)
    position = {r["doc_id"]: r["position"] for r in mixed.collect()}
    # part files are read in any order; each holds a run of the mix
    assert sum(position[b["doc_id"]] == position[a["doc_id"]] + 1 for a, b in zip(stages[3], stages[3][1:])) >= len(stages[3]) - 8


def test_tokens(stages):
    encoder = bpe.Encoder(catalog.RANKS, catalog.PATTERN)
    text = {r["doc_id"]: r["text"] for r in stages[3]}
    assert sorted(r["doc_id"] for r in stages[4]) == sorted(text)
    for r in stages[4]:
        assert r["tokens"] == encoder.encode([text[r["doc_id"]]]).to_pylist()[0]
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, FOLDER).count() == len(stages[4])


def test_last_stage_has_the_order_of_the_mix(spark, stages, tmp_path):
    """Over many part files of unequal size that the reader packs in another order."""
    docs = spark.createDataFrame(stages[2])
    expected = {r["doc_id"]: r["position"] for r in mixing.mix(docs, catalog.TARGET_WEIGHTS, catalog.OTHER_WEIGHT).collect()}
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13", "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "4k"}
    kept = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        corpus_pipeline.mix_sources(spark, docs, FOLDER).write.parquet(f"{tmp_path}/mixed")
        files = len(list((tmp_path / "mixed").glob("part-*")))
        mixed = spark.read.parquet(f"{tmp_path}/mixed")
        read = [expected[r["doc_id"]] for r in mixed.select("doc_id").collect()]
        found = corpus_pipeline.tokenise(spark, mixed, FOLDER).select("doc_id", "position").collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert files > 8 and read != sorted(read)
    assert {r["doc_id"]: r["position"] for r in found} == expected and len(found) == len(expected)


def test_run_has_the_order_of_the_mix(spark, stages):
    expected = {r["doc_id"]: r["position"] for r in mixing.mix(spark.createDataFrame(stages[2]), catalog.TARGET_WEIGHTS, catalog.OTHER_WEIGHT).collect()}
    assert {r["doc_id"]: r["position"] for r in corpus_pipeline.run(spark, FOLDER).collect()} == expected
