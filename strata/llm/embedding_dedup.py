"""Near-duplicate vectors by cosine, with int8 tile products.

Equal vectors are one class.  Classes are dealt to cells (the nearest of the
centroids, fitted on a bounded sample) of about ``CELL_ROWS`` and also visit
every cell of a smaller number that may hold a link.  If y is nearest to
centroid g and x to h, then x.(h - g) <= |x - y| |h - g|, and a link means
|x - y| <= sqrt(2 - 2 threshold): cells beyond that can hold none, so no
link is missed.  Vectors in clear groups visit few cells; vectors that are
spread evenly visit most, and then nearly all pairs are compared.

Inside a cell, tiles of at most about ``TILE`` rows meet tile by tile, so a
crowded cell is many tasks.  A tile product multiplies int8-quantised unit
vectors (exact in float32).  With the exact norm e of each vector's
quantisation error, |x.y - x'.y'| <= (1 + e_x) e_y + e_x; only pairs that
this bound cannot put below the threshold are computed again in double
precision.  So nothing is missed and no link is below the threshold.

A tile reports, for each of its vectors, the number of links and the
smallest vector it is joined to, not the pairs: a group of n near copies
costs n rows for each ``HELD_PAIRS`` pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import connected_components
from strata.session import materialize, ship

THRESHOLD = 0.95
CELL_ROWS = 8192
TILE = 8192
TILE_BYTES = 32 << 20           # of a tile's vectors in double precision
MAX_CELLS = 8192
HELD_PAIRS = 4 << 20
SAMPLE_PER_CELL = 32            # vectors the centroids are fitted on
ROUNDS = 8
SLACK = 1e-6                    # rounding of the float32 scaling
NEAR_SLACK = 1e-4               # and of the float32 products with centroids


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of finite, non-zero vectors at length one, in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes (as float32 for the product), scales, and error norms of unit rows."""
    scale = np.abs(x).max(axis=1) / 127
    code = np.rint(x / scale[:, None]).astype(np.int8)
    return code.astype(np.float32), scale, np.linalg.norm(x - code * scale[:, None], axis=1)


def centroids(sample: np.ndarray, cells: int) -> np.ndarray:
    """Spherical k-means on unit rows; starts from evenly spaced rows."""
    c = sample[np.linspace(0, len(sample) - 1, cells).astype(np.int64)].astype(np.float32)
    x = sample.astype(np.float32)
    for _ in range(ROUNDS):
        near = np.concatenate([(x[i:i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1)
        c[size > 0] = total[size > 0] / size[size > 0, None]
    return c


def rows_of(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def candidates(x: np.ndarray, y: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of unit rows with a cosine of at least ``threshold``."""
    qx, sx, ex = quantise(x)
    qy, sy, ey = quantise(y)
    for lo in range(0, len(x), 256):
        product = (qx[lo:lo + 256] @ qy.T) * sx[lo:lo + 256, None] * sy
        room = (1 + ex[lo:lo + 256, None]) * ey + ex[lo:lo + 256, None] + SLACK
        i, j = np.nonzero(product + room >= threshold)
        for k in range(0, len(i), 65_536):
            a, b = i[k:k + 65_536] + lo, j[k:k + 65_536]
            exact = np.einsum("ij,ij->i", x[a], y[b]) >= threshold
            yield a[exact], b[exact]


def lowest(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id that each position is joined to by the pairs (a, b)."""
    low = ids.copy()
    while True:
        m = np.minimum(low[a], low[b])
        after = low.copy()
        np.minimum.at(after, a, m)
        np.minimum.at(after, b, m)
        if (after == low).all():
            return low
        low = after


def may_link(sims: np.ndarray, home: np.ndarray, gaps: np.ndarray, threshold: float) -> np.ndarray:
    """For each row and cell: whether a vector nearest to that centroid can
    have a cosine of ``threshold`` with the row (see above).  ``sims`` are the
    rows' products with the centroids, ``gaps`` the centroids' distances."""
    far = sims[np.arange(len(sims)), home][:, None] - sims
    return far <= np.sqrt(max(0.0, 2 - 2 * threshold)) * gaps[home] + NEAR_SLACK


def tile_links(table: pa.Table, threshold: float) -> pa.Table:
    """Links of one pair of tiles: (id, low, n) of vectors that have some, a
    row for each HELD_PAIRS pairs at most."""
    dim = table.column("dim")[0].as_py()
    table = table.combine_chunks()
    ids, size, home, left = (table.column(c).to_numpy() for c in ("id", "size", "home", "left"))
    x = unit(rows_of(table.column("vec").combine_chunks(), dim))
    cell = table.column("cell")[0].as_py()
    l, r = np.flatnonzero(left == 1), np.flatnonzero(left == 0)         # noqa: E741
    held: list[tuple[np.ndarray, np.ndarray]] = []
    parts = []
    n = np.zeros(len(ids))

    def folded() -> None:
        a, b = (np.concatenate(v) for v in zip(*held))
        some = np.zeros(len(ids), bool)
        some[a] = some[b] = True
        parts.append(pa.table({"id": ids[some], "low": lowest(a, b, ids)[some], "n": n[some].astype(np.int64)}))
        held.clear()
        n[:] = 0

    for i, j in (candidates(x[l], x[r], threshold) if len(l) and len(r) else ()):
        i, j = l[i], r[j]
        mine = ids[i] != ids[j]
        i, j = i[mine], j[mine]
        inside = home[j] == cell            # these pairs come twice, once from each side
        n += np.bincount(i, weights=size[j], minlength=len(ids))
        n += np.bincount(j[~inside], weights=size[i[~inside]], minlength=len(ids))
        held.append((i, j))
        if sum(len(a) for a, _ in held) >= HELD_PAIRS:
            folded()
    if held:
        folded()
    return pa.concat_tables(parts) if parts else pa.table({k: pa.array([], pa.int64()) for k in ("id", "low", "n")})


def near_duplicate_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           threshold: float = THRESHOLD, probes: int | None = None) -> DataFrame:
    """(id, n_links, component_id, kept), one row per input row.

    n_links counts the other rows whose vector has a cosine of at least
    ``threshold`` with this one; component_id is the smallest id reachable
    by links; kept says whether that is the row's own.  Vectors that are
    null, empty, zero or hold null or non-finite components link with
    nothing, nor do rows with a null id (component null, kept false);
    vectors of different lengths don't link.  Rows with equal vectors link.
    Other columns are not read.  All links are found; ``probes`` has no effect
    any more, as no number of cells bounds the visits.
    """
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("vec"))
    good = (F.col("id").isNotNull() & (F.size("vec") > 0)
            & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0))
    rows = rows.withColumn("ok", F.coalesce(good, F.lit(False))).withColumns({"h1": F.xxhash64("vec"), "h2": F.hash("vec")})
    classes = materialize(rows.where("ok").groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("size"),
                                                                   F.min_by("vec", "id").alias("vec")), "vector-classes")
    dims = {r.d: r["count"] for r in classes.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()}
    dim, n = next(iter(dims.items()), (0, 0))
    cells = max(1, min(MAX_CELLS, int(np.ceil(n / CELL_ROWS))))
    tile = max(256, min(TILE, TILE_BYTES // (8 * max(dim, 1))))
    taken = classes.where(F.size("vec") == dim).select("vec").limit(SAMPLE_PER_CELL * cells).toArrow().column("vec").combine_chunks()
    middles = centroids(unit(rows_of(taken, dim)), min(cells, len(taken))) if len(taken) else np.empty((0, dim), np.float32)
    products = middles.astype(np.float64) @ middles.T.astype(np.float64)
    square = np.diag(products)
    gaps = np.sqrt(np.maximum(square[:, None] + square - 2 * products, 0)).astype(np.float32)
    shared = spark.sparkContext.broadcast((middles, gaps))
    element = classes.schema["vec"].dataType.elementType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, between = shared.value
        for b in batches:
            size = np.diff(b.column(2).offsets.to_numpy()) if len(b.column(2)) else np.empty(0)
            home, many, visits = -size.astype(np.int64), np.zeros(len(size), np.int64), []
            own = np.flatnonzero(size == dim)
            step = max(1, (4 << 20) // max(1, len(c)))
            for lo in range(0, len(own), step):
                at = own[lo:lo + step]
                sims = unit(rows_of(b.column(2).take(pa.array(at)), dim)).astype(np.float32) @ c.T
                home[at] = sims.argmax(axis=1)
                # a link between two cells is found in the smaller, by the visit of the other's vector
                row, cell = np.nonzero(may_link(sims, home[at], between, threshold) & (np.arange(len(c)) < home[at][:, None]))
                many[at] = np.bincount(row, minlength=len(at))
                visits.append(cell)
            offsets = pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(home),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(visits) if visits else np.empty(0), pa.int64()))],
                ["id", "size", "vec", "home", "visits"])

    placed = materialize(classes.select("id", "size", "vec")
                         .mapInArrow(assign, f"id long, size long, vec array<{element}>, home long, visits array<long>"), "cells")
    stays = placed.withColumn("cell", F.col("home")).drop("visits")
    comes = placed.withColumn("cell", F.explode("visits")).drop("visits")
    everyone = stays.unionByName(comes)
    counts = (everyone.groupBy("cell").agg(F.count_if(F.col("cell") == F.col("home")).alias("homes"), F.count("*").alias("rows"))
              .select("cell", *(F.ceil(F.col(c) / tile).cast("int").alias(c) for c in ("homes", "rows"))).where("homes > 0"))
    spread = F.xxhash64("id")
    tiled = everyone.join(counts, "cell")
    # left: rows at home in the cell, in every tile of the others; right: all rows, against every tile of the homes
    left = (tiled.where("cell = home").withColumn("lt", F.pmod(spread, "homes").cast("int"))
            .withColumn("rt", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).withColumn("left", F.lit(1)))
    right = (tiled.withColumn("rt", F.pmod(spread, "rows").cast("int"))
             .withColumn("lt", F.explode(F.sequence(F.lit(0), F.col("homes") - 1))).withColumn("left", F.lit(0)))
    cols = ["cell", "lt", "rt", "left", "id", "size", "vec", "home", F.size("vec").alias("dim")]
    found = materialize(left.select(*cols).union(right.select(*cols)).groupBy("cell", "lt", "rt")
                        .applyInArrow(lambda t: tile_links(t, threshold), "id long, low long, n long"), "vector-links")
    links = found.groupBy("id").agg(F.sum("n").alias("n")).withColumnRenamed("id", "rep")
    joined = connected_components(found.select("id", "low")).withColumnRenamed("id", "rep")
    out = (rows.join(classes.select("h1", "h2", F.col("id").alias("rep"), "size"), ["h1", "h2"], "left")
           .join(links, "rep", "left").join(joined, "rep", "left"))
    own = F.when(F.col("ok"), F.coalesce("component", "rep")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col),
                      F.when(F.col("ok"), F.col("size") - 1 + F.coalesce("n", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
                      own.alias("component_id"), F.coalesce(own == F.col("id"), F.lit(False)).alias("kept"))
