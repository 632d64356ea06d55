"""Property tests (hypothesis): each example is a batch of rows checked in
one Spark job against a plain-Python model of the rule."""

import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions.numbers import parse_number
from strata.functions.text import MULTI_CHAR_FOLDS, fold_ascii
from strata.operators.nearest import nearest_join
from strata.operators.winner import winner_wide

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.decimals(min_value=-10 ** 6, max_value=10 ** 6, places=2, allow_nan=False),
                min_size=1, max_size=40))
def test_parse_number_roundtrip(spark, values):
    texts = [(f"{v:.2f}".replace(".", ",") + " %",) for v in values]
    got = [r[0] for r in spark.createDataFrame(texts, "t string").select(parse_number("t")).collect()]
    assert got == [float(f"{v:.2f}") for v in values]


LATIN = "".join(chr(c) for c in range(0x20, 0x250) if chr(c).isprintable())


def _fold_py(s: str) -> str:
    for k, v in MULTI_CHAR_FOLDS.items():
        s = s.replace(k, v)
    out = []
    for ch in s:
        d = unicodedata.normalize("NFD", ch)
        if (0xC0 <= ord(ch) <= 0x24F and d[0].isascii() and d[0].isalpha() and len(d) > 1
                and all(unicodedata.combining(m) for m in d[1:])):
            out.append(d[0])
        else:
            out.append(ch)
    return "".join(out)


@SETTINGS
@given(st.lists(st.text(alphabet=LATIN, max_size=30), min_size=1, max_size=30))
def test_fold_ascii_matches_decomposition(spark, texts):
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string")
           .select(fold_ascii("t")).collect()]
    assert got == [_fold_py(t) for t in texts]


@SETTINGS
@given(st.lists(st.lists(st.one_of(st.none(), st.integers(0, 5)), min_size=3, max_size=3),
                min_size=1, max_size=40))
def test_winner_wide_matches_rule(spark, rows_):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows_)], "id int, a int, b int, c int")
    got = {r.id: r.winner for r in winner_wide(df, ["a", "b", "c"], max_out=None).collect()}
    for i, r in enumerate(rows_):
        top = max(x for x in r if x is not None) if any(x is not None for x in r) else None
        want = None if top is None else "abc"[[j for j, x in enumerate(r) if x == top][0]]
        assert got[i] == want


panel = st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 30))),
                 min_size=1, max_size=40)
history = st.dictionaries(st.tuples(st.integers(0, 3), st.integers(0, 30)),
                          st.floats(0, 100, allow_nan=False), max_size=25)


@SETTINGS
@given(panel, history, st.sampled_from(["fill", "window", "minby", "lookup"]),
       st.sampled_from(["distinct", "rows"]))
def test_nearest_matches_brute_force(spark, left, right, form, probe_rows):
    ldf = spark.createDataFrame([(i, k, p) for i, (k, p) in enumerate(left)], "id int, k int, p int")
    rdf = spark.createDataFrame([(k, q, v) for (k, q), v in right.items()] or [(9, 0, 0.0)],
                                "k int, q int, v double")
    out = nearest_join(ldf, rdf, ["k"], "p", "q", ["v"], form=form, buckets=4,
                       probe_rows=probe_rows)
    got = {r.id: (r.match_period, r.v) for r in out.collect()}
    for i, (k, p) in enumerate(left):
        cands = [(q, v) for (kk, q), v in right.items() if kk == k]
        if p is None or not cands:
            assert got[i] == (None, None)
        else:
            assert got[i] == min(cands, key=lambda c: (abs(p - c[0]), -c[0]))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50)), min_size=1, max_size=60),
       st.integers(2, 12))
def test_exact_quantiles_match_numpy(spark, data, few):
    import numpy as np

    from strata.operators.stats import exact_quantiles
    df = spark.createDataFrame([(g, float(x) / 4) for g, x in data], "g int, x double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.g: r for r in exact_quantiles(df, "x", probs, ["g"], k=8, cells=16, few=few).collect()}
    for g in {g for g, _ in data}:
        xs = np.array([x / 4 for gg, x in data if gg == g])
        for p in probs:
            assert abs(got[g][f"q{int(p * 100):02d}"] - np.percentile(xs, p * 100)) < 1e-9


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 9)), min_size=2, max_size=60),
       st.integers(1, 4))
def test_auc_matches_pair_count(spark, data, buckets):
    from strata.operators.ml import auc_by_class
    df = spark.createDataFrame([(c, float(s)) for c, s in data], "label string, s double")
    got = auc_by_class(df, "label", {"a": "s"}, buckets=buckets, split_over=2).first()
    pos = [s for c, s in data if c == "a"]
    neg = [s for c, s in data if c != "a"]
    if not pos or not neg:
        assert got.auc is None
        return
    u = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert abs(got.auc - u / (len(pos) * len(neg))) < 1e-12


@SETTINGS
@given(st.lists(st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=3, max_size=3),
                min_size=1, max_size=40))
def test_wide_and_long_winners_agree(spark, rows_):
    from strata.operators.reshape import unpivot
    from strata.operators.winner import winner_long
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows_)], "id int, a int, b int, c int")
    wide = {r.id: r.winner for r in winner_wide(df, ["a", "b", "c"], max_out=None).collect()}
    long = unpivot(df, ["id"], ["a", "b", "c"], "label", "v")
    lw = {r.id: r.winner for r in winner_long(long, ["id"], "label", "v", max_out=None).collect()}
    assert wide == lw


@SETTINGS
@given(st.lists(st.integers(-20, 20), min_size=2, max_size=80), st.integers(1, 12))
def test_histogram_matches_numpy(spark, xs, bins):
    import numpy as np

    from strata.operators.stats import histogram
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    got = [r["count"] for r in sorted(histogram(df, "v", bins).collect(), key=lambda r: r.bin)]
    if max(xs) == min(xs):
        assert got[0] == len(xs) and sum(got) == len(xs)
        return
    want, _ = np.histogram(np.array(xs, dtype=float), bins=bins)
    assert got == list(want)
