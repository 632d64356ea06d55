import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import merkle
from strata.llm.merkle import lowered_where_due, merkle_manifest
from tests.llm import data

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(digests):
    """Root of a list of digests, and each one's siblings on the way."""
    proofs, at = [""] * len(digests), list(range(len(digests)))
    while len(digests) > 1:
        for i, k in enumerate(at):
            run = digests[k // 16 * 16:k // 16 * 16 + 16]
            proofs[i] += "".join(run[:k % 16] + run[k % 16 + 1:])
            at[i] = k // 16
        digests = [sha(*digests[k:k + 16]) for k in range(0, len(digests), 16)]
    return digests[0], proofs


def folded(digest, digests, k):
    while len(digests) > 1:
        run = digests[k // 16 * 16:k // 16 * 16 + 16]
        digest = sha(*run[:k % 16], digest, *run[k % 16 + 1:])
        digests = [sha(*digests[j:j + 16]) for j in range(0, len(digests), 16)]
        k //= 16
    return digest


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    out, sources = [], sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        trees[s] = sorted(((r[0] is not None, r[0] or 0, leaf(r), r) for r in rows if r[1] == s), key=lambda x: x[:3])
    subroots = {s: climb([x[2] for x in trees[s]]) for s in sources}
    root, tops = climb([subroots[s][0] for s in sources])
    for k, s in enumerate(sources):
        digests = [x[2] for x in trees[s]]
        for i, (_, _, d, r) in enumerate(trees[s]):
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = text.translate(data.LOWER)
            f = folded(leaf((*r[:4], text)), digests, i)
            f = folded(f, [subroots[x][0] for x in sources], k)
            out.append((r[0], d, subroots[s][0], root, sha(subroots[s][1][i], tops[k]), f, f == root))
    return sorted(out, key=repr)


def manifest(df):
    got = merkle_manifest(df, COLUMNS, {"text": lowered_where_due()})
    return sorted(map(tuple, got.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256), "folded_root", "verified").collect()), key=repr)


def docs(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string, tree string, no long, leaf long")
    return df.repartition(5)


def test_odd_rows(spark):
    df = data.documents(spark, data.odd_texts()).withColumn("text", F.initcap("text"))
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    got = manifest(df)
    assert got == brute(rows)
    assert {x[6] for x in got} == {True, False}


@pytest.mark.parametrize("sizes", [{"a": 1}, {None: 1, "": 1, "a": 257, "ß": 16, "b": 17}, {"a": 4097, "b": 2},
                                   {f"s{i}": 1 + i % 3 for i in range(300)}])
def test_shapes(spark, sizes):
    rows = [(i, s, "en" if i % 2 else None, None, f"Text {i % 7}") for s, n in sizes.items() for i in range(n)]
    assert manifest(docs(spark, rows)) == brute(rows)


def test_high_nodes_are_joined_in_copies(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RUNS_PER_COPY", 3)
    monkeypatch.setattr(merkle, "CLIMB", merkle.CLIMB.replace("/ 4096", "/ 3"))
    rows = [(i % 900, f"s{i % 4 // 3}", None, i, "Ab") for i in range(1200)]
    assert manifest(docs(spark, rows)) == brute(rows)


def test_repeated_rows_ties_and_nothing(spark):
    rows = [(5, None, None, None, None)] * 20 + [(None, "x", None, None, t) for t in ("A", "B", "A", None)] * 9
    assert manifest(docs(spark, rows)) == brute(rows)
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    assert manifest(docs(spark, rows).where("false")) == []
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
