import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import periodic_runs as module
from strata.llm.periodic_runs import _chunks, find_runs, periodic_runs
from strata.llm.queries import op13_digest
from tests.llm import data


def brute(words):
    """(start, length, period) of every run, by trying all periods."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(24, 3 * q):
                part = words[i:j + q]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def runs_of(words):
    hashes = np.array([int.from_bytes(hashlib.md5(str(w).encode()).digest()[:8], "little") for w in words], np.uint64)
    codes = np.unique(hashes, return_inverse=True)[1].astype(np.int64)
    got = find_runs(codes, hashes, np.array([0, len(words)]))
    return [(b, e - b, q) for b, e, q in got.tolist()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 9)), max_size=6))
def test_runs_of_repeated_parts(parts):
    words = [w for part, times in parts for w in part * times]
    assert runs_of(words) == brute(words)


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_longer_texts(seed):
    rng, words = random.Random(seed), []
    while len(words) < 2500:
        p = rng.choice([1, 2, 3, 7, 8, 16, 17, 18, 25, 26, 40, 99, 150, 233])
        part = [rng.randrange(rng.choice([2, 5, 50, 1000])) for _ in range(p)]
        if rng.random() < 0.3:
            part = part * 2 + part[:p // 2] + [0]
        words += (part * 6)[:rng.randrange(p, 5 * p + 30)] + [rng.randrange(5) for _ in range(rng.randrange(20))]
    assert runs_of(words) == brute(words)


def test_a_text_with_few_words_is_scanned_in_bounded_work():
    rng = random.Random(3)
    words = [rng.randrange(3) for _ in range(200_000)] + [rng.randrange(9) for _ in range(30_000)] * 4
    assert (200_000, 120_000, 30_000) in [(s, n, q) for s, n, q in runs_of(words) if q > 20_000]
    assert runs_of([1] * 300_000) == [(0, 300_000, 1)]
    assert runs_of([1, 2, 3] * 50_000 + [9]) == [(0, 150_000, 3)]


def texts():
    rng = random.Random(6)
    rows = data.odd_texts()
    for i in range(400, 460):
        part = [f"w{rng.randrange(30)}" for _ in range(rng.choice([1, 2, 5, 9, 24, 60]))]
        head = [f"h{rng.randrange(9)}" for _ in range(rng.randrange(40))]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(head + (part * 9)[:rng.randrange(8, 9 * len(part) + 9)] + head)))
    return rows + [(500, "a " * 23), (501, "a " * 24), (502, "é " * 30 + "ß"), (503, "  b\x0b" * 40), (504, "a " * 30), (504, "a " * 30)]


def test_table(spark, monkeypatch):
    rows = texts()
    got = sorted((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(data.documents(spark, rows)).collect() if r.doc_id is not None)
    want = []
    for i, t in rows:
        words = data.WORD.findall(t or "")
        if i is not None:
            runs = brute(words) if len(words) < 5000 else []
            want.append((i, len(words), runs, " ".join(collapsed(words, runs))))
    assert got == sorted(want)
    assert periodic_runs(data.empty(spark)).count() == 0
    assert periodic_runs(data.documents(spark, rows).where("doc_id is null")).count() == 2


def test_a_text_longer_than_a_chunk_is_read_in_pieces(monkeypatch):
    rng = random.Random(2)
    column = pa.array(["x y", None, " ".join(rng.choice(["a", "bb", "ccc" * 200, "dé"]) for _ in range(3000)) + "\n", "", "q" * 5000, "z"])
    whole = [(w.low, w.data.tobytes(), w.start.tolist(), w.end.tolist(), w.first.tolist(), h.tolist()) for w, h in _chunks(column)]
    monkeypatch.setattr(module, "CHUNK_BYTES", 600)
    cut = [(w.low, w.data.tobytes(), w.start.tolist(), w.end.tolist(), w.first.tolist(), h.tolist()) for w, h in _chunks(column)]
    assert len(whole) == 1 and len(cut) > 3
    assert [x for c in cut for x in c[5]] == whole[0][5]
    words = lambda chunks: [c[1][a:b] for c in chunks for a, b in zip(c[2], c[3])]                     # noqa: E731
    assert words(cut) == words(whole)


def test_query_against_brute_force(spark):
    rows = texts()
    got = sorted(map(tuple, op13_digest(data.documents(spark, rows)).collect()), key=repr)
    want = []
    for i, t in rows:
        words = data.WORD.findall(t or "")
        n, h = len(words), None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = brute(words) if n < 5000 else runs_of(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        text = "".join("%d,%d,%d\n" % r for r in runs)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()                                          # noqa: E731
        want.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(text), sha(" ".join(collapsed(words, runs)))))
    assert got == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in got) > 20
