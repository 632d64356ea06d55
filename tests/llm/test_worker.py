"""Worker caches of one operator at a time; scores of texts of any length."""

import numpy as np
import pyarrow as pa

from strata.llm import language_id, worker
from strata.llm.words import LOWER, SPACE


def test_another_operator_drops_the_caches():
    made = []
    make = lambda: made.append(1) or len(made)      # noqa: E731
    assert worker.kept("a", "k", make) == worker.kept("a", "k", make) == 1
    assert worker.kept("a", "other", make) == 2
    worker.begin("a")
    assert worker.kept("a", "k", make) == 1
    worker.begin("b")
    assert worker.kept("a", "k", make) == 3
    assert worker.kept("b", "k", make) == 4 and worker.kept("a", "k", make) == 5


def test_mean_scores_do_not_depend_on_pieces(monkeypatch):
    rnd = np.random.default_rng(5)
    table = np.asfortranarray(rnd.normal(size=(language_id.BUCKETS, 3)).astype(np.float32))
    texts = [None, "", "a", "ab", "abc", *("".join(rnd.choice(list("abcdé \n"), n)) for n in (3, 4, 7, 60, 1, 0, 500, 2, 33)), "", None]

    def brute(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        b = LOWER[raw].astype(np.uint64)
        b[SPACE[raw]] = 32
        at = [((int(b[i]) << 16 | int(b[i + 1]) << 8 | int(b[i + 2])) * 2654435761 % 2 ** 32) >> 16 for i in range(len(b) - 2)]
        return [*(table[at].astype(float).mean(axis=0) if at else [0, 0, 0]), len(at)]

    want = np.array([brute(t) for t in texts])
    column = pa.array(["prefix", *texts])[1:]
    for chunk in (1, 2, 3, 5, 16, 64, 1 << 19):
        monkeypatch.setattr(language_id, "CHUNK", chunk)
        got = np.array(language_id.mean_scores(column, table).to_pylist())
        assert np.allclose(got, want, atol=1e-5), chunk
    empty = pa.array(["", None], pa.string())
    assert language_id.mean_scores(empty, table).to_pylist() == [[0.0] * 4] * 2
    assert language_id.mean_scores(pa.array([], pa.string()), table).to_pylist() == []


def test_scoring_beside_the_evidence_gives_the_same(spark):
    from tests.conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = ["row.doc_id", "declared", "host", "text_language", "language", "accepted"]
    a, b = (sorted(map(tuple, language_id.identify_documents(docs, keep).select(*columns).collect())) for keep in (None, ["doc_id"]))
    assert a == b and len(a) == docs.count()
