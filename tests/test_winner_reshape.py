"""C12, C13, A1-A4, C15 edge rows."""

from pyspark.sql import functions as F

from strata.operators.reshape import (allocate_columns, panel_sum, pivot_discovered, pivot_sparse,
                                      pivot_values, unpivot)
from strata.operators.winner import winner_long, winner_wide
from tests.conftest import rows

EDGES = [("tie", 1, 5, 5, 1), ("nulls", 1, None, None, None), ("zeros", 1, 0, 0, None),
         ("onenull", 1, None, 3, 2), ("dot", 1, 1, 2, 9)]


def test_winner_wide_edges(spark):
    df = spark.createDataFrame(EDGES, "e string, p int, A int, B int, `X.Y` int")
    w = winner_wide(df, ["A", "B", "X.Y"], tie_out="tie")
    got = {r.e: (r.winner, r.max_value, r.tie) for r in w.collect()}
    assert got["tie"] == ("A", 5, True)
    assert got["nulls"] == (None, 0, False)
    assert got["zeros"] == ("A", 0, True)
    assert got["onenull"] == ("B", 3, False)
    assert got["dot"] == ("X.Y", 9, False)


def test_wide_and_long_agree(spark):
    df = spark.createDataFrame(EDGES, "e string, p int, A int, B int, `X.Y` int")
    wide = winner_wide(df, ["A", "B", "X.Y"])
    long = unpivot(df, ["e", "p"], ["A", "B", "X.Y"])
    lw = winner_long(long, ["e", "p"], "label", "value")
    assert rows(wide, "e", "winner") == rows(lw, "e", "winner")


def test_pivots_and_unpivot(spark):
    df = spark.createDataFrame([("a", 1, "Summe", 10.0), ("a", 1, "Sport", 4.0), ("a", 1, "Sport", 1.0),
                                ("b", 1, "Förderung x", 2.0)], "e string, p int, c string, v double")
    s = panel_sum(df, ["e", "p"], "v", exclude_categories=["Summe"], category_col="c")
    assert rows(s) == [("a", 1, 5.0), ("b", 1, 2.0)]
    pv = pivot_values(df, ["e", "p"], "c", ["Sport", "Missing"], "v", "max")
    assert rows(pv, "e", "Sport", "Missing") == [("a", 4.0, None), ("b", None, None)]
    pd_ = pivot_discovered(df, ["e", "p"], "c", "v", prefix="SubCat_")
    assert set(pd_.columns) == {"e", "p", "SubCat_Forderung_x", "SubCat_Sport", "SubCat_Summe"}
    assert rows(pd_, "e", "SubCat_Sport") == [("a", 5.0), ("b", 0.0)]
    back = unpivot(pd_, ["e", "p"], ["SubCat_Sport"], "label", "v")
    assert rows(back, "e", "v") == [("a", 5.0), ("b", 0.0)]


def test_allocation_sums_to_measure(spark):
    df = spark.createDataFrame([(1, 2.0, 6.0, 8.0, 100.0), (2, 0.0, 0.0, 0.0, 50.0),
                                (3, None, 4.0, 4.0, 10.0)], "id int, x double, y double, t double, m double")
    a = allocate_columns(df, ["x", "y"], "t", "m").collect()
    assert a[0].x_alloc + a[0].y_alloc == 100.0
    assert (a[1].x_alloc, a[1].y_alloc) == (0.0, 0.0)
    assert a[2].x_alloc is None and a[2].y_alloc == 10.0


def test_discover_values_bound(spark):
    import pytest

    from strata.operators.reshape import discover_values
    df = spark.range(20).withColumn("c", F.col("id").cast("string"))
    assert len(discover_values(df, "c", limit=20)) == 20
    with pytest.raises(ValueError):
        discover_values(df, "c", limit=19)


def test_nothing_is_cut_by_default(spark):
    df = spark.createDataFrame([("a", None, 7.0)] + [("a", "x", 0.001)] * 10 + [(None, "x", 1e17), ("b", None, None)], "e string, c string, v double")
    assert [(e, v and round(v, 9)) for e, v in rows(panel_sum(df, ["e"], "v"))] == [("a", 7.0 + 10 * 0.001), ("b", None), (None, 1e17)]
    assert rows(panel_sum(df, ["e"], "v", exclude_categories=["x"], category_col="c")) == [("a", 7.0), ("b", None)]
    p = pivot_discovered(df, ["e"], "c", "v", prefix="C_")
    assert p.columns == ["e", "C_x", "C_null"]
    assert rows(p) == [("a", 0.01, 7.0), ("b", 0.0, 0.0), (None, 1e17, 0.0)]
    w = winner_long(spark.createDataFrame([("a", "x", 2), ("a", "y", None), ("n", "x", None)], "e string, l string, v int"), ["e"], "l", "v")
    assert rows(w) == [("a", "x", 2), ("n", None, None)]


def test_pivot_sparse_has_no_limit_on_values(spark):
    many = (spark.range(24_000).select((F.col("id") % 2).alias("e"), F.concat(F.lit("v"), (F.col("id") % 12_000).cast("string")).alias("c"),
                                       F.col("id").cast("double").alias("v")))
    one = pivot_sparse(many, ["e"], "c", "v")
    assert {(r.e, len(r.cells), sum(r.cells.values())) for r in one.collect()} == {
        (e, 6_000, float(sum(range(e, 24_000, 2)))) for e in (0, 1)}
    parts = pivot_sparse(many, ["e"], "c", "v", blocks=8)
    got = parts.collect()
    assert len(got) == 16 and max(len(r.cells) for r in got) < 1_000
    back = parts.select("e", F.explode("cells").alias("c", "v"))
    want = many.groupBy("e", "c").agg(F.sum("v").alias("v"))
    assert back.exceptAll(want).count() == want.exceptAll(back).count() == 0


def test_pivot_sparse_edges(spark):
    data = [("a", "x", 1.0), ("a", "x", 2.0), ("a", None, 4.0), ("a", "null", 8.0), (None, "x", 5.0), ("b", "y", None), ("n", None, 3.0)]
    df = spark.createDataFrame(data, "`e.1` string, c string, v double")
    for blocks in (1, 3):
        p = pivot_sparse(df, ["e.1"], "c", "v", blocks=blocks)
        got = {}
        for r in p.collect():
            cells, null = got.setdefault(r["e.1"], ({}, []))
            cells.update(r.cells)
            null += [r.null_cell] * (r.null_cell is not None)
        assert got == {"a": ({"x": 3.0, "null": 8.0}, [4.0]), None: ({"x": 5.0}, []), "b": ({"y": None}, []), "n": ({}, [3.0])}
    assert pivot_sparse(df.limit(0), ["e.1"], "c", "v").count() == 0
