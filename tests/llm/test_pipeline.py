import corpus_pipeline as pipeline
from tests.llm.test_packing_dedup import check_packed
from tests.llm.test_similarity import contained_by_force, near_by_force
from tidewatch.llm import queries, toxicity

SF = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(spark, docs, tmp_path):
    stages = dict(pipeline.STAGES)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    score = {r.doc_id: r.score for r in toxicity.score(docs, queries.toxicity_model(spark, docs, SF)).collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def stage(name, frame):
        out = str(tmp_path / name)
        stages[name](spark, frame, SF).write.parquet(out)
        return spark.read.parquet(out)

    def same(frame, expected):
        assert frame.columns == docs.columns
        assert sorted((r.doc_id, r.text) for r in frame.collect()) == sorted(expected)

    left = [(i, t) for i, t in rows if score[i] < 0.7]
    frame = stage("toxicity", docs)
    same(frame, left)
    left = [(i, t) for t, i in {t: i for i, t in sorted(left)}.items()]
    frame = stage("exact_dedup", frame)
    same(frame, left)
    first = {i: c for i, c, _, _ in near_by_force(left)}
    left = [(i, t) for i, t in left if first[i] == i]
    frame = stage("ngram_jaccard_join", frame)
    same(frame, left)
    leaks = {i for i, *_ in contained_by_force(left, items)}
    left = [(i, t) for i, t in left if i not in leaks]
    frame = stage("benchmark_decontamination", frame)
    same(frame, left)
    packed = stages["best_fit_packing"](spark, frame, SF).collect()
    check_packed(packed, left, 2048)
    ran = pipeline.run(spark, SF).collect()
    check_packed(ran, left, 2048)


def test_stages_take_odd_and_empty_tables(spark, odd, none):
    for frame in (odd, none):
        for name, stage in pipeline.STAGES:
            out = stage(spark, frame, SF)
            assert out.count() <= frame.count() or name == "best_fit_packing"
            assert name == "best_fit_packing" or out.columns == frame.columns
    assert [name for name, _ in pipeline.STAGES] == [
        "toxicity", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
