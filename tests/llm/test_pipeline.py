"""The pipeline's stages, each judged on its own input."""

import duckdb
import pytest

import corpus_pipeline
from claimloom.llm.latent import benchmark_leaks
from claimloom.llm.toxicity import fit, score

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out, docs = tmp_path_factory.mktemp("pipeline"), spark.read.parquet(f"{SF_DIR}/documents.parquet")
    frames = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF_DIR).write.parquet(f"{out}/{k}")
        frames.append(spark.read.parquet(f"{out}/{k}"))
    return frames


def ids(frame):
    return [r["doc_id"] for r in frame.select("doc_id").collect()]


def test_columns(stages):
    for frame in stages[:-1]:
        assert frame.columns == stages[0].columns
    assert stages[-1].columns == [*stages[0].columns, "slot", "shard"]


def test_toxic_documents_go(spark, stages):
    model = fit(stages[0], spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    clean = score(stages[0], model).where("predicted = 0")
    assert sorted(ids(stages[1])) == sorted(ids(clean))
    toxic = {d for d, in duckdb.sql(f"SELECT doc_id FROM '{SF_DIR}/labels.parquet' WHERE toxic = 1").fetchall()}
    fine = {d for d, in duckdb.sql(f"SELECT doc_id FROM '{SF_DIR}/labels.parquet' WHERE toxic = 0").fetchall()}
    kept = set(ids(stages[1]))
    assert len(toxic & kept) < 0.15 * len(toxic) and len(fine & kept) > 0.95 * len(fine)


def test_one_of_each_group_of_near_duplicates_stays(stages):
    from test_queries import brute_components, brute_fingerprint

    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in stages[1].select("doc_id", "text").collect()}
    ids_ = list(prints)
    linked = [(a, b) for i, a in enumerate(ids_) for b in ids_[:i] if (prints[a] ^ prints[b]).bit_count() <= 2]
    assert linked and sorted(ids(stages[2])) == sorted(set(brute_components(ids_, linked).values()))


def test_leaking_documents_go(spark, stages):
    leaking = set(ids(benchmark_leaks(stages[2], spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))))
    assert leaking and sorted(ids(stages[3])) == sorted(set(ids(stages[2])) - leaking)


def test_the_mix_takes_its_words(stages):
    size = {r["doc_id"]: len((r["text"] or "").split()) for r in stages[3].select("doc_id", "text").collect()}
    taken = ids(stages[4])
    assert set(taken) <= set(size) and max(map(taken.count, set(taken))) <= 2
    assert sum(size[d] for d in taken) == pytest.approx(1.5 * sum(size.values()), rel=0.05)


def test_every_row_is_placed(stages):
    rows = stages[5].select("doc_id", "shard").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(ids(stages[4])) and {r["shard"] for r in rows} == set(range(32))
    assert len({(r["doc_id"], r["shard"]) for r in rows}) == len({r["doc_id"] for r in rows})


def test_run_is_the_stages_one_after_another(spark, stages):
    assert sorted(map(repr, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(repr, stages[-1].collect()))


def test_empty_and_odd_documents_go_through(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, None, "en", None, None)], docs.schema)
    for frame, least in ((docs.limit(0), 0), (odd, 1)):
        for _, stage in corpus_pipeline.STAGES[:3]:
            frame = stage(spark, frame, SF_DIR)
        assert frame.count() >= least
        for _, stage in corpus_pipeline.STAGES[3:]:
            frame = stage(spark, frame, SF_DIR)
        assert frame.columns[-2:] == ["slot", "shard"] and frame.count() >= 0
