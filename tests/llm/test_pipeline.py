import corpus_pipeline
from dayledger.llm.shared import stored
from fixtures import EDGE, prose
from test_line_dedup import plain as plain_lines
from test_simhash import plain_near_duplicates


def good(n, words=120):
    return f"The story of the day: {prose(n, words)}"


def test_stages_take_effect(spark, tmp_path):
    leak = prose(500, 30)
    rows = [(n, good(n)) for n in range(20)]
    rows += [(30, good(3)), (31, good(4) + " end")]  # an exact and a near copy
    rows += [(40, f"{good(60)}\n{leak}\n{good(61)}"), (41, "too short"), (42, "### " * 80), (43, None)]
    shared = "This very line stands in three documents"
    rows += [(50 + n, f"{good(70 + n)}\n{shared}") for n in range(3)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    path = str(tmp_path)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    kept, current = {}, spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        current = stored(stage(spark, current, path), f"test-{name}")
        if name != "packing":
            assert current.columns == docs.columns
            kept[name] = {r.doc_id: r for r in current.collect()}
    ids = {n for n, _ in rows}
    assert set(kept["quality_rules"]) == ids - {41, 42, 43}
    assert set(kept["line_dedup"]) == set(kept["quality_rules"])
    assert [shared in kept["line_dedup"][50 + n].text for n in range(3)] == [False, False, True]
    assert all(r.n_chars == len(r.text) for r in kept["line_dedup"].values())
    before = [(i, r.text) for i, r in kept["line_dedup"].items()]
    assert sorted(kept["near_dedup"]) == plain_near_duplicates(before) == sorted(set(kept["line_dedup"]) - {30, 31})
    assert set(kept["decontamination"]) == set(kept["near_dedup"]) - {40}
    assert {r.doc_id for r in current.collect()} == set(kept["decontamination"])
    again = corpus_pipeline.run(spark, path)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, current.collect()))


def test_edge_rows_pass(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "x") for i, t in EDGE], "doc_id long, text string, row string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= {i for i, _ in EDGE}


def test_line_stage_is_the_operator(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, sf_dir).collect()}
    import hashlib

    assert {(i, h) for i, _, _, h in plain_lines(rows)} == {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in out.items()}
