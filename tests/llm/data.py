"""Small tables with everything that is odd, and brute-force helpers."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# columns whose names the operators use inside
EXTRA = ["id", "row", "size", "n", "rep", "token", "component", "text_key", "target", "value", "at", "part", "key", "vec"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)


def words(n, rng, vocabulary=400):
    return " ".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") + str(rng.randrange(vocabulary)) for _ in range(n))


def edited(text, rng, changes):
    w = text.split(" ")
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"zz{rng.randrange(10 ** 6)}"
    return " ".join(w)


def odd_texts(seed=5):
    """(doc_id, text) with nulls, blanks, ties, repeats, copies and a very long text."""
    rng = random.Random(seed)
    base, long = words(120, rng), words(30_000, rng, 10 ** 6)
    shared = words(20, rng, 10 ** 6)
    rows = [(1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (5, "One  TWO"), (None, base), (None, None), (6, long), (6, long), (7, "x" * 50_000),
            (8, "it's Ok, we'll see:  <|endoftext|>three\x1cfour   café İİ é \U0001f600 12,5 <|startoftext|>"), (9, " leading"), (10, "trailing \n"),
            (-3, base), (11, edited(long, rng, 40)), (2 ** 62, "a b c d e")]
    for i in range(20, 60):
        rows.append((i, edited(base, rng, rng.randrange(0, 9))))
    for i in range(60, 90):
        rows.append((i, words(rng.randrange(1, 60), rng) + " " + shared + " " + words(rng.randrange(1, 60), rng)))
    for i in range(90, 110):
        rows.append((i, base))
    return rows


def documents(spark, rows):
    out = []
    for k, (i, t) in enumerate(rows):
        source = None if k % 7 == 0 else f"src{k % 3}"
        out.append((i, t, None if k % 5 == 0 else "en", source, len(t or ""), *(["clash"] * len(EXTRA))))
    return spark.createDataFrame(out, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def smallest_reachable(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {i: find(i) for i in ids}
