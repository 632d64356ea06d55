"""Statistics.

Everything is an aggregate over the whole input with partial aggregation,
a join to a one-row-per-group statistics table, or a window over an already
aggregated table.  No operator collects rows to the driver or sends one
group's raw rows to one task.

One rule for odd values: null, NaN and the infinities are missing values in
every statistic.  A null group is a group of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize

# ---- fixed values: the band names, from the mean outwards ---------------------
BANDS = ("Near Mean", "Moderate", "Extreme")


def _col(c) -> Column:
    """A string is a literal column name (dots and spaces allowed, SURVEY
    H12); pass a Column for nested fields."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


def fround(c, places: int) -> Column:
    """floor(x * 10^p + 0.5) / 10^p in double precision: the same IEEE steps
    in any engine, so a value exactly halfway rounds identically everywhere.
    Spark's ``floor`` gives BIGINT; from 2^52 on a double is whole already,
    so only smaller values pass through it.  NaN stays NaN."""
    s = float(10 ** places)
    x = _col(c) * F.lit(s) + F.lit(0.5)
    return F.when(F.abs(x) < F.lit(2.0 ** 52), F.floor(x).cast("double")).otherwise(x) / F.lit(s)


def finite(c) -> Column:
    """The value as double, null if it is NaN or infinite (NaN compares as
    the largest double)."""
    x = _col(c).cast("double")
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def join_groups(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null equals null."""
    named = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    on = [left[f"`{k}`"].eqNullSafe(named[f"`_key_{k}`"]) for k in keys]
    return left.join(named, on, how).drop(*[f"_key_{k}" for k in keys])


def attach(df: DataFrame, stats: DataFrame, groups=()) -> DataFrame:
    """Join a statistics table back to the rows.  A global (one-row)
    table is broadcast: its size is proven; per-group tables are joined on
    the group keys (null included) and AQE decides the strategy from their
    measured size."""
    if not groups:
        return df.crossJoin(F.broadcast(stats))
    return join_groups(df, stats, list(groups))


# ---- A5, A6, J7 --------------------------------------------------------------

def entity_profile(df: DataFrame, entity, **measures: Column) -> DataFrame:
    """One aggregation for all per-entity measures (instead of one
    aggregate per measure joined together)."""
    return df.groupBy(*([entity] if isinstance(entity, str) else entity)).agg(
        *[c.alias(n) for n, c in measures.items()])


# ---- A10 ----------------------------------------------------------------------

def corr(x, y) -> Column:
    """Pearson correlation over rows with two finite values; null (not an
    error) when a variance is zero.  ``DataFrame.stat.corr`` is not used: it does
    not skip rows where only one side is null."""
    x, y = finite(x), finite(y)
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def correlations(df: DataFrame, pairs, places: int = 6) -> DataFrame:
    """One row, one column ``corr_<x>_<y>`` per pair, in one pass."""
    return df.agg(*[fround(corr(x, y), places).alias(f"corr_{x}_{y}") for x, y in pairs])


def correlation_matrix(df: DataFrame, columns, groups=(), places: int = 6) -> DataFrame:
    """One row per group and pair of columns (x <= y in the order given):
    the rows with two finite values, their covariance (population) and
    correlation, null where a variance is zero.

    A row's finite values become (x, y, a, b) rows of one generator, so the
    plan has one covariance and two deviations whatever the number of columns;
    their partial aggregates are mergeable co-moments, one per task, group
    and pair, and those alone are shuffled.  A column without values, and a
    group without pairs, has no rows; a null group is a group.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("name"), finite(c).alias("v")) for i, c in enumerate(columns)])
    known = F.filter(cells, lambda c: c["v"].isNotNull())
    pairs = F.flatten(F.transform(known, lambda x: F.transform(
        F.filter(known, lambda y: y["i"] >= x["i"]),
        lambda y: F.struct(x["name"].alias("x"), y["name"].alias("y"), x["v"].alias("a"), y["v"].alias("b")))))
    long = df.select(*[_col(g) for g in groups], F.inline(pairs))
    spread = F.stddev_pop("a") * F.stddev_pop("b")
    return long.groupBy(*[_col(g) for g in groups], "x", "y").agg(
        F.count(F.lit(1)).alias("n"), fround(F.covar_pop("a", "b"), places).alias("covariance"),
        fround(F.try_divide(F.covar_pop("a", "b"), spread), places).alias("correlation"))


# ---- A9, C16, C17 ---------------------------------------------------------------

def band_of(deviation: Column, sd: Column, cuts=(1.0, 2.0), names=BANDS) -> Column:
    """The band of a deviation: ``names[k]`` where k cut points (multiples of
    the standard deviation) are exceeded, with the side from the second on."""
    passed = sum(((F.abs(deviation) > c * sd).cast("int") for c in cuts), F.lit(0))
    side = F.when(passed == 0, "").when(deviation > 0, " High").otherwise(" Low")
    return F.when(deviation.isNotNull() & sd.isNotNull(),
                  F.concat(F.element_at(F.array(*map(F.lit, names)), passed + 1), side))


def sigma_bands(df: DataFrame, value: str, out: str = "band", dev_out: str = "deviation",
                groups=(), stats_from: DataFrame | None = None, cuts=(1.0, 2.0), names=BANDS) -> DataFrame:
    """Deviation from the mean and a band at ``cuts`` sample standard
    deviations.  A missing value (see the module) gets neither.
    ``stats_from`` takes the mean and sd from another frame with the same
    rows (e.g. an already materialised table), so ``df``'s plan is not run
    twice."""
    src = df if stats_from is None else stats_from
    st = src.groupBy(*groups).agg(F.avg(finite(value)).alias("_mean"), F.stddev_samp(finite(value)).alias("_sd"))
    j = attach(df, st, groups)
    d = finite(value) - F.col("_mean")
    return j.withColumns({dev_out: d, out: band_of(d, F.col("_sd"), cuts, names)}).drop("_mean", "_sd")


# ---- A7, A8, J6, C19, O1 -------------------------------------------------------

def share_within_group(df: DataFrame, group: str, category: str, places: int = 2,
                       count_out: str = "count", total_out: str = "total",
                       pct_out: str = "pct") -> DataFrame:
    """Count per (group, category) and its share of the group total.  The
    total comes from a window over the aggregated counts, not a self-join."""
    c = df.groupBy(group, category).agg(F.count(F.lit(1)).alias(count_out))
    w = Window.partitionBy(group)
    c = c.withColumn(total_out, F.sum(count_out).over(w))
    return c.withColumn(pct_out, fround(F.col(count_out) / F.col(total_out) * 100, places))


# ---- G1, G2 ------------------------------------------------------------------

def trend_line(df: DataFrame, x: str, y: str, groups=(), places: int = 6) -> DataFrame:
    """OLS y ~ x per group: n, slope, intercept, r2, slope standard error,
    residual standard error (the closed forms behind a regression plot)."""
    fx, fy = finite(x), finite(y)
    sxx, syy, sxy = F.regr_sxx(fy, fx), F.regr_syy(fy, fx), F.regr_sxy(fy, fx)
    n = F.regr_count(fy, fx)
    g = df.groupBy(*groups).agg(
        n.alias("n"), F.regr_slope(fy, fx).alias("slope"), F.regr_intercept(fy, fx).alias("intercept"),
        F.regr_r2(fy, fx).alias("r2"), sxx.alias("_sxx"), syy.alias("_syy"), sxy.alias("_sxy"),
        F.avg(F.when(fy.isNotNull(), fx)).alias("x_mean"))
    resid = F.col("_syy") - F.try_divide(F.col("_sxy") * F.col("_sxy"), F.col("_sxx"))
    resid_var = F.try_divide(resid, F.col("n") - 2)
    g = g.withColumns({
        "resid_se": F.sqrt(F.greatest(resid_var, F.lit(0.0))),
        "slope_se": F.sqrt(F.greatest(F.try_divide(resid_var, F.col("_sxx")), F.lit(0.0))),
    })
    out = ["slope", "intercept", "r2", "resid_se", "slope_se", "x_mean"]
    return g.select(*groups, "n", *[fround(c, places).alias(c) for c in out])


def trend_band(df: DataFrame, x: str, y: str, groups=(), points: int = 50, z: float = 1.959964) -> DataFrame:
    """Fitted line and its 95 % confidence band of the mean on an even grid
    of ``points`` x values per group (normal quantile, closed form)."""
    pairs = df.withColumns({x: finite(x), y: finite(y)}).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    st = pairs.groupBy(*groups).agg(
        F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("b"),
        F.regr_intercept(y, x).alias("a"), F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"),
        F.avg(x).alias("xm"), F.min(x).alias("x0"), F.max(x).alias("x1"))
    grid = st.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    gx = F.col("x0") + (F.col("x1") - F.col("x0")) * F.col("i") / F.lit(max(points - 1, 1))
    s = F.sqrt(F.try_divide(F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx")),
                            F.col("n") - 2))
    dx = gx - F.col("xm")
    se = s * F.sqrt(F.lit(1.0) / F.col("n") + F.try_divide(dx * dx, F.col("sxx")))
    fit = F.col("a") + F.col("b") * gx
    return grid.select(*groups, "i", gx.alias("x"), fit.alias("fit"),
                       (fit - z * se).alias("lower"), (fit + z * se).alias("upper"))


# ---- A13, A14 ------------------------------------------------------------------

def distribution_stats(df: DataFrame, value: str, groups=(), places: int = 6) -> DataFrame:
    """n, mean, sample sd, bias-adjusted skewness (as pandas ``skew``), min,
    max of the finite values."""
    n = F.count(value)
    g = df.withColumn(value, finite(value)).groupBy(*groups).agg(n.alias("n"), F.avg(value).alias("mean"),
                                F.stddev_samp(value).alias("stddev"),
                                F.skewness(value).alias("_g1"), F.min(value).alias("min"),
                                F.max(value).alias("max"))
    nn = F.col("n").cast("double")
    adj = F.when(F.col("n") > 2, F.col("_g1") * F.sqrt(nn * (nn - 1)) / (nn - 2))
    return g.select(*groups, "n", *[fround(c, places).alias(c) for c in ("mean", "stddev")],
                    fround(adj, places).alias("skewness"), "min", "max")


# ---- G5 ---------------------------------------------------------------------------

def _numpy_bin(x, lo, hi, bins: int):
    """numpy.histogram's bin of x for ``bins`` equal bins over [lo, hi]:
    scaled index, the top value into the last bin, then corrected against
    the edges ``i * (hi - lo) / bins + lo`` so a value on an edge lands
    exactly where numpy (and so a seaborn plot) puts it."""
    span = hi - lo
    step = span / F.lit(float(bins))

    def edge(i):
        return i * step + lo
    b0 = F.least(F.floor((x - lo) * (F.lit(float(bins)) / span)), F.lit(bins - 1))
    b1 = F.when(x < edge(b0), b0 - 1).otherwise(b0)
    b2 = F.when((b1 != bins - 1) & (x >= edge(b1 + 1)), b1 + 1).otherwise(b1)
    return F.when(span > 0, b2).otherwise(F.lit(0)).cast("int")


def histogram(df: DataFrame, value: str, bins: int = 30, groups=()) -> DataFrame:
    """Equal-width bins between min and max, as ``numpy.histogram`` counts
    them (max in the last bin, edge values in the upper bin); empty bins are
    listed with count 0."""
    base = df.select(*groups, finite(value).alias(value)).where(F.col(value).isNotNull())
    st = base.groupBy(*groups).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    span = F.col("hi") - F.col("lo")
    b = _numpy_bin(F.col(value), F.col("lo"), F.col("hi"), bins)
    counts = attach(base, st, groups).groupBy(*groups, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    edges = st.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = span / F.lit(bins)
    edges = edges.select(*groups, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                         (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"))
    return join_groups(edges, counts, [*groups, "bin"], "left").fillna(0, subset=["count"])


# ---- G6 --------------------------------------------------------------------------

def kde(df: DataFrame, value: str, grid: int = 200, bins: int = 200, groups=(),
        places: int = 8) -> DataFrame:
    """Gaussian kernel density on an even grid, Scott bandwidth sd * n^-1/5.

    Values are first counted into ``bins`` equal-width bins (one partial
    aggregation over the data).  A group's filled bins, at most ``bins``, then
    stand in one array, and each grid point adds the kernel up over it, so
    a group costs filled bins * grid steps of arithmetic and no rows but
    its ``grid`` rows of output, however many groups there are.
    """
    base = df.select(*groups, finite(value).alias(value)).where(F.col(value).isNotNull())
    st = base.groupBy(*groups).agg(F.min(value).alias("lo"), F.max(value).alias("hi"),
                                   F.count(F.lit(1)).alias("n"),
                                   F.stddev_samp(value).alias("sd"))
    span = F.col("hi") - F.col("lo")
    b = F.when(span > 0, F.least(F.floor((F.col(value) - F.col("lo")) / span * bins),
                                 F.lit(bins - 1))).otherwise(F.lit(0))
    # the statistics ride along with the bin counts (constant per group), so
    # the data is read twice (range, then bins) and never a third time
    stats = [F.first(c).alias(c) for c in ("lo", "hi", "n", "sd")]
    k = attach(base, st, groups).groupBy(*groups, b.alias("bin")).agg(F.count(F.lit(1)).alias("c"), *stats)
    k = k.groupBy(*groups).agg(F.sort_array(F.collect_list(F.struct("bin", "c"))).alias("cells"), *stats)
    if not groups:
        k = k.where(F.col("n").isNotNull())         # no value, no curve
    k = k.withColumns({"span": span, "h": F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))})

    def density(x: Column) -> Column:
        # a zero bandwidth (all values equal) has no density: null, not an ANSI error
        def kernel(cell: Column) -> Column:
            u = F.try_divide(x - (F.col("lo") + (cell["bin"] + 0.5) * F.col("span") / F.lit(bins)), F.col("h"))
            return F.try_divide(cell["c"] * F.exp(-0.5 * u * u), F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))
        return F.aggregate("cells", F.lit(0.0), lambda total, cell: total + kernel(cell))

    xs = F.transform(F.sequence(F.lit(0), F.lit(grid - 1)), lambda j: F.col("lo") + F.col("span") * j / F.lit(max(grid - 1, 1)))
    curve = F.transform("xs", lambda x: F.struct(x.alias("x"), density(x).alias("density")))
    out = k.withColumn("xs", xs).select(*groups, F.posexplode(curve).alias("point", "at"))
    return out.select(*groups, "point", fround(F.col("at.x"), places).alias("x"), fround(F.col("at.density"), places).alias("density"))


def density_mode(kde_df: DataFrame, groups=()) -> DataFrame:
    """The mode read off a density curve (the grid point with the highest
    density), per group, from ``kde`` output (at most ``grid`` rows per
    group, so this is a small aggregation)."""
    return kde_df.groupBy(*groups).agg(F.max_by("x", "density").alias("mode"),
                                       F.max("density").alias("max_density"))


# ---- G3, G4: exact quantiles without gathering a group -------------------------

SKETCH_K = 200      # KLL sketch parameter: a rank error of about 1.7 %, 2.6 kB however many values
SALTS = 16          # first-level sketches a group is merged from
CELLS = 256         # cells a bracket is counted in
FEW = 64            # values a bracket may hold when they are ranked


def _sketched(base: DataFrame, groups: list[str], k: int) -> DataFrame:
    """n, min, max and a KLL sketch per group, merged in two levels: a group's
    partial sketches meet by scan task first, then SALTS of them."""
    salted = base.select(*groups, "_x", (F.spark_partition_id() % SALTS).alias("_salt"))
    first = salted.groupBy(*groups, "_salt").agg(
        F.kll_sketch_agg_double("_x", F.lit(k)).alias("_s"), F.count(F.lit(1)).alias("n"),
        F.min("_x").alias("min"), F.max("_x").alias("max"))
    return first.groupBy(*groups).agg(F.kll_merge_agg_double("_s", F.lit(k)).alias("_s"), F.sum("n").alias("n"),
                                      F.min("min").alias("min"), F.max("max").alias("max")).where(F.col("n") > 0)


def _bracketed(base: DataFrame, brackets: DataFrame, groups: list[str], row) -> DataFrame:
    """(groups, i, row's fields) for every value and bracket for which ``row``
    is not null; a group's brackets are joined as one array."""
    lists = brackets.groupBy(*groups).agg(F.collect_list(F.struct("i", "lo", "hi")).alias("_b"))
    rows = attach(base, lists, groups)
    hits = F.filter(F.transform("_b", row), lambda h: h.isNotNull())
    return rows.select(*groups, F.explode(hits).alias("_h")).select(*groups, "_h.*")


def _cell(x: Column, lo: Column, hi: Column, cells: int) -> Column:
    """Number of x's cell among ``cells`` equal ones over [lo, hi], -1 below
    and ``cells`` above.  Halves keep the width of any two doubles finite."""
    width = hi / 2 - lo / 2
    inside = F.when(width > 0, F.least(F.floor((x / 2 - lo / 2) / width * cells), F.lit(cells - 1))).otherwise(F.lit(0))
    return F.when(x < lo, F.lit(-1)).when(x > hi, F.lit(cells)).otherwise(inside).cast("int")


def _narrowed(base: DataFrame, brackets: DataFrame, groups: list[str], cells: int, every: bool) -> DataFrame:
    """Each bracket cut to the cell that holds its rank, by one partial
    aggregation of counts.  ``lo`` and ``hi`` are values of that cell,
    ``below`` counts the values under it, ``inside`` those in it and
    ``after`` is the next value above it."""
    def row(b: Column) -> Column:
        cell = F.struct(b["i"].alias("i"), _cell(F.col("_x"), b["lo"], b["hi"], cells).alias("_cell"), F.col("_x").alias("_v"))
        return cell if every else F.when(F.col("_x").between(b["lo"], b["hi"]), cell)

    counted = _bracketed(base, brackets, groups, row).groupBy(*groups, "i", "_cell").agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    old = brackets.select(*groups, "i", "rank", F.col("below").alias("_below"), F.col("after").alias("_after"))
    order = Window.partitionBy(*groups, "i").orderBy("_cell")
    upto = F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = join_groups(counted, old, [*groups, "i"]).withColumns({
        "below": F.col("_below") + upto - F.col("_c"), "after": F.coalesce(F.lead("lo").over(order), F.col("_after"))})
    return (cum.where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("_c")))
            .select(*groups, "i", "rank", "lo", "hi", "below", F.col("_c").alias("inside"), "after"))


def exact_quantiles(df: DataFrame, value, probs, groups=(), names=None, k: int = SKETCH_K,
                    cells: int = CELLS, few: int = FEW) -> DataFrame:
    """Linear-interpolation quantiles (``percentile`` / ``quantile_cont``),
    exact, per group, without sending a group to one task.

    A KLL sketch per group brackets the rank of each wanted quantile.  Then
    the brackets are counted in ``cells`` equal cells each (partial
    aggregation) and cut to the cell with the rank, until none holds more than
    ``few`` values or all that it holds are equal; the first count covers the
    whole range, so a sketch that is off only costs a round.  Last the distinct
    values in the brackets are counted and ranked.  No task holds more than
    SALTS sketches, ``cells`` + 2 counts or ``few`` values of a group and
    quantile, whatever its size and distribution.

    ``df`` is scanned once by the sketch, once by each round (a round divides
    the values in a bracket by about ``cells``: one for a million values, two
    for a hundred million) and once by the ranking.  Each step's result, one
    row per group and quantile, is written; the number of open brackets is
    what reaches the driver.
    """
    groups = list(groups)
    names = names or [f"q{int(round(p * 100)):02d}" for p in probs]
    base = df.select(*groups, finite(value).alias("_x")).where(F.col("_x").isNotNull())
    stats = materialize(_sketched(base, groups, k), "quantile-sketch")
    off = 4.0 / k
    at = lambda rank: F.kll_sketch_get_quantile_double("_s", F.lit(rank))                                  # noqa: E731
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p"), at(max(0.0, p - off)).alias("lo"),
                                at(min(1.0, p + off)).alias("hi")) for i, p in enumerate(probs)])
    now = stats.select(*groups, "n", F.explode(wanted).alias("_w")).select(
        *groups, "_w.i", F.floor(F.col("_w.p") * (F.col("n") - 1).cast("double")).alias("rank"), "_w.lo", "_w.hi",
        F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"), F.lit(None).cast("double").alias("after"))
    # a width of zero between unequal values is one of two neighbouring subnormal numbers
    wide = (F.col("lo") < F.col("hi")) & (F.col("hi") / 2 - F.col("lo") / 2 > 0) & (F.col("inside") > few)
    settled, every = [], True
    while True:
        now, every = materialize(_narrowed(base, now, groups, cells, every), "quantile-brackets"), False
        settled.append(now.where(~wide))
        now = now.where(wide)
        if now.isEmpty():
            break
    ends = settled[0]
    for s in settled[1:]:
        ends = ends.union(s)
    # the distinct values of the brackets that hold more than one
    counted = _bracketed(base, ends.where("lo < hi"), groups, lambda b: F.when(
        F.col("_x").between(b["lo"], b["hi"]), F.struct(b["i"].alias("i"), F.col("_x").alias("_v")))) \
        .groupBy(*groups, "i", "_v").agg(F.count(F.lit(1)).alias("_c"))
    equal = ends.where("lo = hi").select(*groups, "i", F.col("lo").alias("_v"), F.col("inside").alias("_c"))
    order = Window.partitionBy(*groups, "i").orderBy("_v")
    below = F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_c")
    ranked = (join_groups(counted.union(equal), ends.select(*groups, "i", "rank", "below", "after"), [*groups, "i"])
              .withColumns({"below": F.col("below") + below, "after": F.coalesce(F.lead("_v").over(order), F.col("after"))}))
    ranked = (ranked.where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("_c")))
              .select(*groups, "i", F.col("_v").alias("low"),
                      F.when(F.col("rank") + 1 < F.col("below") + F.col("_c"), F.col("_v")).otherwise(F.coalesce("after", "_v")).alias("high")))
    picked = ranked.groupBy(*groups).agg(*[F.max(F.when(F.col("i") == i, F.col(c))).alias(f"_{c}{i}")
                                           for i in range(len(probs)) for c in ("low", "high")])
    q = attach(stats.drop("_s"), picked, groups)
    outs = []
    for i, (p, nm) in enumerate(zip(probs, names)):
        h = F.lit(float(p)) * (F.col("n") - 1).cast("double")
        outs.append((F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * (h - F.floor(h))).alias(nm))
    return q.select(*groups, "n", "min", "max", *outs)


def _fences(df: DataFrame, value, groups, whisker: float) -> DataFrame:
    """Quartiles and fences, one written row per group (its size is known to
    the planner of the join that follows)."""
    qs = exact_quantiles(df, value, [0.25, 0.5, 0.75], groups, names=["q1", "median", "q3"])
    qs = qs.withColumn("iqr", F.col("q3") - F.col("q1"))
    return materialize(qs.withColumns({"lo_fence": F.col("q1") - whisker * F.col("iqr"),
                                       "hi_fence": F.col("q3") + whisker * F.col("iqr")}), "box-fences")


def box_stats(df: DataFrame, value: str, groups=(), whisker: float = 1.5, places: int = 6,
              log10: bool = False) -> DataFrame:
    """Five-number summary with whiskers at the last values inside
    q1 - 1.5 IQR and q3 + 1.5 IQR, plus the outlier count.  ``log10``
    summarises log10(value) over positive values (a log-scale axis)."""
    groups = list(groups)
    x = finite(value)
    base = df.select(*groups, (F.when(x > 0, F.log10(x)) if log10 else x).alias("_x")).where(F.col("_x").isNotNull())
    qs = _fences(base, "_x", groups, whisker)
    j = attach(base, qs, groups)
    outside = (F.col("_x") < F.col("lo_fence")) | (F.col("_x") > F.col("hi_fence"))
    carried = ["n", "min", "q1", "median", "q3", "iqr", "max"]
    out = j.groupBy(*groups).agg(
        *[F.first(c).alias(c) for c in carried],        # constant per group
        F.min(F.when(F.col("_x") >= F.col("lo_fence"), F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(F.col("_x") <= F.col("hi_fence"), F.col("_x"))).alias("whisker_hi"),
        F.sum(outside.cast("long")).alias("n_outliers"))
    num = ["min", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi", "max"]
    return out.select(*groups, "n", *[fround(c, places).alias(c) for c in num], "n_outliers")


def box_outliers(df: DataFrame, value: str, groups=(), keep=(), whisker: float = 1.5) -> DataFrame:
    """The rows outside the whisker fences, with their group's fences."""
    groups = list(groups)
    rows = df.select(*dict.fromkeys([*keep, *groups, value]))
    fences = _fences(rows, value, groups, whisker).select(*groups, "lo_fence", "hi_fence")
    x = finite(value)
    return attach(rows, fences, groups).where((x < F.col("lo_fence")) | (x > F.col("hi_fence")))
