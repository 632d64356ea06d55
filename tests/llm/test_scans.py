import random

import duckdb
import numpy as np
import pytest

from strata.llm import language_id as L
from strata.llm.decontaminate import clean, contamination
from strata.llm.license_scan import TEMPLATES, Templates, scan_licenses
from strata.llm.mixing import mix, mixed_rows, n_words
from strata.llm.queries import OP8_SQL
from tests.llm import data


def test_contamination_is_exact_containment(spark):
    rng = random.Random(9)
    items = [(i, data.words(rng.randrange(1, 90), rng, 10 ** 6)) for i in range(40)] + [(40, None), (41, ""), (None, data.words(30, rng, 10 ** 6)), (0, data.words(25, rng, 10 ** 6))]
    rows = data.odd_texts()
    for k in range(200, 260):
        item = rng.choice(items)[1] or "x"
        rows.append((k, data.words(rng.randrange(0, 400), rng) + " " + data.edited(item, rng, rng.randrange(0, 3)).upper() + " " + data.words(rng.randrange(1, 900), rng)))
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, item string")
    got = [(r.doc_id, r.contaminated, r.n_items, round(r.containment or 0, 9)) for r in contamination(data.documents(spark, rows), bench).collect()]
    sets = {data.shingles(t) for _, t in items if data.shingles(t)}
    want = []
    for i, t in rows:
        share = [len(s & d) / len(s) for d in [data.shingles(t)] for s in sets]
        hit = [x for x in share if x >= 0.8]
        want.append((i, bool(hit), len(hit), round(max(hit, default=0), 9)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[1] for r in got) > 20
    kept = clean(data.documents(spark, rows), bench)
    assert kept.columns == data.documents(spark, []).columns if False else kept.count() == sum(not r[1] for r in want)
    assert contamination(data.empty(spark), bench).count() == 0
    assert not any(r.contaminated for r in contamination(data.documents(spark, rows), bench.limit(0)).collect())


def test_licenses(spark):
    rng = random.Random(4)
    rows = data.odd_texts() + [(300 + k, data.words(rng.randrange(0, 300), rng) + "\n" + t.upper() + "\n" + data.words(9, rng)) for k, (_, t) in enumerate(TEMPLATES)]
    got = {r.doc_id: r for r in scan_licenses(data.documents(spark, rows)).collect()}
    texts = dict(rows)
    for k, (name, text) in enumerate(TEMPLATES):
        r = got[300 + k]
        assert name in r.licenses
        m = next(m for m in r.matches if m.license == name)
        raw = texts[300 + k].encode()[m.start_byte:m.end_byte].decode()
        assert m.containment == 1.0 and raw.split()[0].lower().strip('("') == text.split()[0].lower()
    assert all(not got[i].licenses for i, _ in data.odd_texts())
    assert scan_licenses(data.empty(spark)).count() == 0
    assert scan_licenses(data.documents(spark, rows), templates=[]).count() == len(rows)


def test_license_bands_retrieve_what_is_contained():
    import pyarrow as pa

    from strata.llm.license_scan import SHINGLE, folded_chunks
    rng = random.Random(8)
    texts = [("t", data.words(n + 4, rng, 10 ** 6)) for n in (1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 60)]
    known = Templates(texts, 80)
    missed = 0
    for trial in range(20):
        for i, (_, t) in enumerate(texts):
            doc = data.words(200, rng, 10 ** 6) + " " + t + " " + data.words(150, rng, 10 ** 6)
            for w in folded_chunks(pa.array([doc])):
                s, owner = w.shingles(w.hashes(), SHINGLE)
                missed += (0, i) not in known.retrieved(s, owner)
    assert missed == 0


def test_mixing_matches_sql_and_targets(spark, tmp_path):
    rng = random.Random(2)
    rows = [(None if k % 50 == 0 else k // 2, None if k % 9 == 0 else data.words(rng.randrange(0, 60), rng) * rng.choice([0, 1, 1, 1]),
             None if k % 4 == 0 else rng.choice(["A", "b", "é", "big", "big", "big", "tiny"]) if k != 3 else "lonely", "clash") for k in range(3000)]
    rows = [r for r in rows if r[2] != "tiny" or rng.random() < 0.02] + rows[5:8] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    df = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = mix(df, n_words("text")).selectExpr("row.doc_id", "size", "source_size", "target", "copies * size taken").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, got), key=repr) == sorted(con.execute(OP8_SQL).fetchall(), key=repr)
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r)
        assert r.taken <= 3 * r.size
    for (size, target), own in by.items():
        assert target <= 3 * size + 1e-6 and abs(sum(r.taken for r in own) - target) <= 2 * max(r.size for r in own)
    assert abs(sum(t for _, t in by) - sum(s for s, _ in by)) < 1e-6 * sum(s for s, _ in by)
    again = mixed_rows(df.repartition(13), n_words("text"))
    assert again.columns == df.columns
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, mixed_rows(df, n_words("text")).collect()), key=repr)
    assert mix(df.limit(0), n_words("text")).count() == 0


def _speech(lang, n, rng):
    return " ".join(rng.choice({"aa": ["the", "and", "shing", "whed"], "bb": ["der", "und", "schen", "keit"], "cc": ["que", "eaux", "les", "ment"]}[lang])
                    + rng.choice(["", "s", "e"]) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(6)
    return spark.createDataFrame([(i, _speech(g, rng.randrange(5, 80), rng), g) for i in range(600) for g in [("aa", "bb", "cc")[i % 3]]], "doc_id long, text string, lang string")


def test_language_held_out_accuracy(spark, labelled):
    rng = random.Random(77)
    rows = [(i, _speech(g, rng.randrange(3, 40), rng), None, f"h{i % 4}", g) for i in range(300) for g in [("aa", "bb", "cc")[i % 3]]]
    rows += [(900, "你好世界" * 40, "aa", "h1", "und"), (901, None, "bb", "h1", "bb"), (902, "", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row string")
    from pyspark.sql import functions as F
    found = L.identify(df, F.col("text"), F.col("lang"), [F.col("source").alias("host"), F.lit("").alias("domain"), F.lit("").alias("suffix")],
                       L.fit(labelled, "text", "lang")).collect()
    assert len(found) == len(rows)
    right = [r.language == r.row.row for r in found if r.row.doc_id < 900]
    assert sum(right) / len(right) > 0.98
    odd = {r.row.doc_id: r for r in found if r.row.doc_id >= 900}
    assert not any(r.accepted for r in odd.values()) and odd[900].language == "und" and odd[901].text_language is None
    assert L.identify_documents(data.empty(spark)).count() == 0


def test_language_evidence_decides_where_text_does_not(spark, labelled):
    """Posterior against the formula computed by hand in numpy."""
    rng = random.Random(5)
    rows = [(i, f"http://www.{'x' if i % 2 else 'y'}.example.{'fr' if i % 2 else 'com'}/p", f"<HTML class=a LANG='{'cc-FR' if i % 2 else 'aa'}'><script>und der</script><p>{_speech('cc' if i % 2 else 'aa', 30, rng)}</p>")
            for i in range(200)] + [(500, "http://www.x.example.fr/q", "<html><p>ents</p>"), (501, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.row.page_id: r for r in L.identify_pages(pages, labelled).collect()}
    assert found[500].language == "cc" and found[500].host == "www.x.example.fr"
    assert found[501].language is not None and not found[501].accepted
    assert found[1].declared == "cc" and found[1].language == "cc" and found[0].language == "aa"


def test_trigram_scores_by_hand():
    import pyarrow as pa
    table = np.random.default_rng(0).normal(size=(L.BUCKETS, 3)).astype(np.float32)
    texts = ["abcde", "", None, "xy", "Abc\né", "z" * 5000]
    got = L.mean_scores(pa.array(texts), table).to_pylist()
    for text, row in zip(texts, got):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        want = table[L.trigrams(raw)].mean(axis=0) if len(raw) > 2 else np.zeros(3)
        assert np.allclose(row[:3], want, atol=1e-4) and row[3] == max(0, len(raw) - 2)


def test_every_labelled_language_has_a_model(spark, monkeypatch):
    rng = random.Random(21)
    tongues = [[data.words(1, rng, 10 ** 6) for _ in range(12)] for _ in range(80)]
    names = [f"{'abcdefghij'[k // 10]}{'klmnopqrst'[k % 10]}" for k in range(80)]
    rows = [(100 * k + i, " ".join(rng.choice(own) for _ in range(30)), (n, n.upper(), f"{n}-XX", f" {n}_Latn")[i % 4], f"h{i % 3}")
            for k, (n, own) in enumerate(zip(names, tongues)) for i in range(8)]
    rows += [(9_000, "no such words here at all", "und", "h0"), (9_001, "nor in these ones", " ", "h0"), (9_002, "", "zz", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    assert L.fit(df, "text", "lang")[0] == sorted(names)
    found = {r.row.doc_id: r for r in L.identify_documents(df).collect()}
    assert len(found) == len(rows)
    assert all(found[100 * k + i].language == n and found[100 * k + i].accepted for k, n in enumerate(names) for i in range(8))
    monkeypatch.setattr(L, "MAX_LANGUAGES", 79)
    with pytest.raises(ValueError):
        L.fit(df, "text", "lang")


def test_language_that_has_only_long_texts(spark):
    rng = random.Random(31)
    rows = [(i, _speech(g, 3_000 if g == "cc" else 20, rng), g, "h") for i in range(60) for g in [("aa", "bb", "cc")[i % 3]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    assert min(len(t) for _, t, g, _ in rows if g == "cc") > 8_000
    for docs, names in ((df, ["aa", "bb", "cc"]), (df.where("lang = 'cc'"), ["cc"])):
        got, table = L.fit(docs, "text", "lang")
        assert got == names
        counts = sum(np.bincount(L.trigrams(np.frombuffer(t.encode(), np.uint8)), minlength=L.BUCKETS) for _, t, g, _ in rows if g == "cc")
        want = np.log((counts + L.ALPHA) / (counts.sum() + L.ALPHA * L.BUCKETS))
        assert np.allclose(table[:, names.index("cc")], want, atol=1e-5)
        found = L.identify_documents(docs).collect()
        assert len(found) == docs.count() and all(r.accepted and r.language == r.row.lang for r in found)


def test_trigrams_of_a_text_are_counted_to_its_end(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(L, "CHUNK", 7)
    texts = ["the quick brown fox jumps", "", "ab", None, "abc", "x" * 21]
    want = sum(np.bincount(L.trigrams(np.frombuffer((t or "").encode(), np.uint8)), minlength=L.BUCKETS) for t in texts if len(t or "") > 2)
    assert (L.trigram_counts(pa.array(texts)) == want).all()


def test_bsd_family_and_further_notices(spark):
    begin = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    third = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
             "from this software without specific prior written permission.")
    isc = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.")
    free = ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, "
            "or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.")
    rows = [(1, f"x y {begin} 1. Redistributions of source code"), (2, f"{begin} 1. Redistributions 3. {third} z"), (3, f"a\n{isc}\nb"), (4, free)]
    got = {r.doc_id: r.licenses for r in scan_licenses(data.documents(spark, rows)).collect()}
    assert got == {1: ["BSD"], 2: ["BSD", "BSD-3-Clause"], 3: ["ISC"], 4: ["Unlicense"]}
