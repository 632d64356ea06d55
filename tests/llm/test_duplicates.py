import hashlib
import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import embedding_dedup, ngram_join
from strata.llm.components import connected_components
from strata.llm.embedding_dedup import near_duplicate_vectors
from strata.llm.ngram_join import jaccard_components
from strata.llm.substring_dedup import remove_repeats
from strata.llm.words import word_chunks
from tests.llm import data


def test_components_match_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500 + i, 501 + i) for i in range(60)] + [(900, 900), (None, 3)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    links = [x for x in links if x[0] is not None and x[0] != x[1]]
    want = data.smallest_reachable({i for x in links for i in x}, links)
    assert got == want


def test_words_and_shingles_are_the_texts():
    rows = [t for _, t in data.odd_texts()]
    seen = {}
    for size in (1, 700, 1 << 22):
        for c in word_chunks(pa.array(rows, pa.string()), size):
            s, owner = c.shingles(c.hashes(lower=True), 5)
            for i in range(len(c.counts)):
                w = data.WORD.findall((rows[c.low + i] or "").translate(data.LOWER))
                want = [tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))] if w else []
                got = s[owner == i].tolist()
                assert len(got) == len(want)
                for h, words in zip(got, want):
                    assert seen.setdefault(h, words) == words


@pytest.mark.parametrize("frequent", [3, 1])
def test_jaccard_components(spark, frequent, monkeypatch):
    # frequent=1: nearly all shingles are "frequent", so prefixes lengthen and need several matches
    monkeypatch.setattr(ngram_join, "FREQUENT_SEEN", frequent)
    rows = data.odd_texts()
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(data.documents(spark, rows)).collect()}
    sets = {i: data.shingles(t) for i, t in rows if i is not None}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    up = data.smallest_reachable(sets, links)
    want = {(i, len(data.shingles(t)), up.get(i)) for i, t in rows}
    assert got == want
    assert len({c for _, _, c in want}) < len(want)


def test_jaccard_of_nothing(spark):
    assert jaccard_components(data.empty(spark)).count() == 0
    alone = jaccard_components(data.documents(spark, [(1, None), (None, None), (2, "")])).collect()
    assert sorted(map(tuple, alone), key=repr) == [(1, 0, 1), (2, 0, 2), (None, 0, None)]


def test_remove_repeats(spark):
    rows = data.odd_texts()
    got = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest(),
            tuple((s.start, s.end) for s in r.removed)) for r in remove_repeats(data.documents(spark, rows)).collect()]
    first = {}
    for i, t in rows:
        w = data.WORD.findall(t or "")
        if i is not None:
            for j in range(len(w) - 12):
                k = tuple(w[j:j + 13])
                first[k] = min(first.get(k, i), i)
    want = []
    for i, t in rows:
        w = data.WORD.findall(t or "")
        gone = [False] * len(w)
        for j in range(len(w) - 12 if i is not None else 0):
            if first[tuple(w[j:j + 13])] < i:
                gone[j:j + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        edge = [k for k in range(len(w) + 1) if (k > 0 and gone[k - 1]) != (k < len(w) and gone[k])]
        want.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), tuple(zip(edge[::2], edge[1::2]))))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[2] for r in got) > 1000
    assert remove_repeats(data.empty(spark)).count() == 0


def _vectors(n, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(n // 20, 16))
    x = centre[rng.integers(0, len(centre), n)] + rng.normal(size=(n, 16)) * rng.choice([0.05, 0.3, 1.5], size=(n, 1))
    x[5], x[7] = x[6], 3 * x[6]
    return x


def test_near_duplicate_vectors(spark):
    x = _vectors(1500).astype(np.float32)
    rows = [(i, v.tolist(), "clash", 1) for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] * 16, [1.0] * 15 + [None], [1.0, 2.0]]
    rows += [(10_000 + i, v, "clash", 1) for i, v in enumerate(odd)] + [(None, x[6].tolist(), "clash", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, size int").repartition(4)
    got = {r.vec_id: r for r in near_duplicate_vectors(df).collect()}
    assert len(got) == len(rows)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    linked = (u @ u.T) >= 0.95
    np.fill_diagonal(linked, False)
    links, found = linked.sum(1), np.array([got[i].n_links for i in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.9 * links.sum() and links.sum() > 1000
    for i in range(len(odd)):
        r = got[10_000 + i]
        assert (r.n_links, r.component_id, r.kept) == (0, 10_000 + i, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert got[5].component_id == got[6].component_id == got[7].component_id


def test_all_pairs_with_enough_probes(spark):
    x = _vectors(300, 2)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicate_vectors(df, probes=1000).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    linked = (u @ u.T) >= 0.95
    np.fill_diagonal(linked, False)
    up = data.smallest_reachable(range(len(x)), np.argwhere(linked).tolist())
    assert got == {i: (int(linked[i].sum()), up[i]) for i in range(len(x))}
    assert near_duplicate_vectors(df.limit(0)).count() == 0


def test_no_link_between_cells_is_missed(spark, monkeypatch):
    # vectors without groups, pairs just over the threshold, many cells
    rng = np.random.default_rng(12)
    u = rng.normal(size=(2000, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    off = rng.normal(size=u.shape)
    off -= (off * u).sum(1)[:, None] * u
    off /= np.linalg.norm(off, axis=1)[:, None]
    x = np.concatenate([u, 0.951 * u + np.sqrt(1 - 0.951 ** 2) * off])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    linked = (x @ x.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1)) >= 0.95
    np.fill_diagonal(linked, False)
    up = data.smallest_reachable(range(len(x)), np.argwhere(linked).tolist())
    want = {i: (int(linked[i].sum()), up[i]) for i in range(len(x))}
    assert linked.sum() >= 4000
    for rows in (8192, 100):
        monkeypatch.setattr(embedding_dedup, "CELL_ROWS", rows, raising=False)
        assert {r.vec_id: (r.n_links, r.component_id) for r in near_duplicate_vectors(df).collect()} == want


def test_groups_of_near_copies_in_small_parts(spark, monkeypatch):
    for name, value in (("CELL_ROWS", 40), ("TILE", 256), ("HELD_PAIRS", 50)):
        monkeypatch.setattr(embedding_dedup, name, value)
    x = _vectors(900, 4)
    x[:200] = x[0] + 0.01 * np.random.default_rng(3).normal(size=(200, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    linked = (u @ u.T) >= 0.95
    np.fill_diagonal(linked, False)
    up = data.smallest_reachable(range(len(x)), np.argwhere(linked).tolist())
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicate_vectors(df).collect()}
    assert got == {i: (int(linked[i].sum()), up[i]) for i in range(len(x))}
