import corpus_pipeline
from strata.session import materialize
from tests.llm import data


def test_pipeline_keeps_columns_and_clean_documents(spark, tmp_path):
    rows = data.odd_texts()
    docs = data.documents(spark, rows)
    leak = rows[70][1]
    spark.createDataFrame([(1, " ".join(leak.split()[3:40]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, str(tmp_path)), "test-stage")
        if name == "token_ids":
            assert docs.count() == before.count()
            break
        assert docs.columns == before.columns
        if name == "near_duplicates":
            ids = [r.doc_id for r in docs.collect()]
            assert len(ids) == len(set(ids)) and not set(range(90, 110)) & set(ids) and {60, 61, 62} <= set(ids)
        if name == "decontaminate":
            gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in docs.collect()}
            assert gone == {rows[70][0]}


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    data.empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_against_brute_force(spark):
    words = [f"w{i}" for i in range(400)]
    a, b, c, d = (" ".join(words[i:i + 90]) for i in (0, 100, 200, 300))
    rows = [(3, a), (5, a), (5, b), (5, b), (5, c + " end"), (7, b + " more"), (9, c), (9, d), (11, d), (11, d), (None, a), (None, a),
            (12, None), (13, ""), (13, None), (14, "one two"), (15, "one two"), (15, "one three")]
    rows += [(20 + i, t) for i, (_, t) in enumerate(data.odd_texts()) if t is not None and len(t) < 20_000]
    got = corpus_pipeline.near_duplicates(spark, data.documents(spark, rows), "").select("doc_id", "text").collect()
    got = sorted(((r.doc_id, r.text) for r in got), key=repr)
    nodes = sorted({r for r in rows if r[0] is not None}, key=repr)
    sets = [data.shingles(t) for _, t in nodes]
    links = [(x, y) for x in range(len(nodes)) for y in range(x)
             if sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])]
    group = data.smallest_reachable(range(len(nodes)), links)
    kept = [r for r in got if r[0] is not None]
    assert [r for r in got if r[0] is None] == [r for r in sorted(rows, key=repr) if r[0] is None]
    assert len(kept) == len(set(kept))                                  # no row twice
    assert sorted(group[nodes.index(r)] for r in kept) == sorted(set(group.values()))     # one of every group, no more
