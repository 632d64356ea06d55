"""Nearest-period join.

For every left row, pick the right row of the same key whose period is
closest; on equal distance the later right period wins; no right row for
the key gives nulls.  Right rows must be unique per (key, period) - use
``dedupe_right`` - and right rows with a null period are ignored (a null
period would otherwise sort first and win).

Every form works on *probes*: the distinct (key, period) pairs of the left
side, found with a partially aggregated ``distinct``.  The answer table
is unique per (key, period) and is left-joined back to the left rows; if
one (key, period) holds a third of all left rows, that final join is the
only place it shows up, and AQE's skew-join handling splits the large
side there.

Forms:

``window``  probes x right on key, ``row_number`` by (|dp|, period desc)
            = 1.  Spark plans a partial ``WindowGroupLimit``.  Cost
            probes x history.
``minby``   same join, then ``min_by`` aggregate (partial aggregation).
``fill``    no probe x history product: probes and right rows are put in
            one sorted sequence per (key, piece); the last right row at or
            before a probe and the first one after it come from running
            ``last(ignorenulls)`` windows; pieces without a right row on one
            side get it from a one-row summary per (key, piece) carried
            across pieces.  The pieces come from one range partitioning of
            all rows by (key, period), written once, so a piece holds its
            share of the rows whatever the keys and periods, and a key's
            pieces are no more than the tasks; a caller who knows the period
            unit names pieces of fixed width instead.  O((N + H) log) and the
            default.  With ``probe_rows="rows"`` the left rows themselves go
            through the window (for panels unique per key and period): no
            distinct probes and no join back.
``lookup``  for a right side that a check proves small: its history as one
            sorted array per key, broadcast, and a binary search per left row
            in a native expression; one row per left row in the whole plan.
            Beyond the bound the ``fill`` form answers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numbers import abs_diff
from strata.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, bounded_broadcast, measured
from strata.session import materialize

FORMS = ("fill", "window", "minby", "lookup")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass
class Side:
    """One right-hand input: unique per (keys, period) among the rows where
    ``rows`` holds (all rows when ``rows`` is None).  Sides that share one
    DataFrame and differ only in ``rows`` are read in a single scan."""
    df: DataFrame
    period: str
    values: list[str] = field(default_factory=list)
    prefix: str = ""
    rows: Column | None = None

    def out_period(self) -> str:
        return f"{self.prefix}period" if self.prefix else "match_period"

    def out_value(self, v: str) -> str:
        return f"{self.prefix}{v}"


def dedupe_right(df: DataFrame, keys, period: str, values, agg: str = "max") -> DataFrame:
    """Make the right side unique per (keys, period) with a deterministic
    aggregate, and drop null periods."""
    fn = {"max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg, "first": F.first}[agg]
    return (df.where(F.col(period).isNotNull())
            .groupBy(*keys, period).agg(*[fn(v).alias(v) for v in values]))


def _probes(left: DataFrame, keys, period: str) -> DataFrame:
    return left.select(*keys, period).where(F.col(period).isNotNull()).distinct()


def _right(side: Side, keys) -> DataFrame:
    df = side.df if side.rows is None else side.df.where(side.rows)
    return df.select(*keys, F.col(side.period).alias("_q"), *side.values) \
        .where(F.col("_q").isNotNull())


def _answers_ranked(probes: DataFrame, side: Side, keys, period: str, form: str,
                    broadcast_rows: int | None) -> DataFrame:
    """window / minby forms: answers (keys, period, _q, values)."""
    r = _right(side, keys)
    if broadcast_rows:
        r = bounded_broadcast(r, broadcast_rows)
    j = probes.join(r, list(keys), "inner").withColumn(
        "_d", abs_diff(period, "_q"))
    if form == "window":
        w = Window.partitionBy(*keys, period).orderBy(F.col("_d").asc(), F.col("_q").desc())
        return (j.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
                .select(*keys, period, "_q", *side.values))
    best = F.min_by(F.struct("_q", *side.values), F.struct(F.col("_d"), -F.col("_q"))).alias("_b")
    return (j.groupBy(*keys, period).agg(best)
            .select(*keys, period, "_b._q", *[F.col(f"_b.{v}").alias(v) for v in side.values]))


# range pieces per shuffle partition: several small ones even out which task they meet in
PIECES = 4


def _pieces(rows: DataFrame, keys, tie, pieces: int | None) -> DataFrame:
    """The rows with ``_b``, their piece in the order of (key, period, right
    rows first).  Written once: a second run would cut elsewhere.  ``tie``
    orders equal rows, so even one (key, period) may spread over pieces."""
    n = pieces or PIECES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*[F.col(k) for k in keys], F.col("_t"), F.col("_r").desc(), *tie]
    return materialize(rows.repartitionByRange(n, *order).withColumn("_b", F.spark_partition_id().cast("long")), "nearest-pieces")


def _answers_lookup(left: DataFrame, sides: list[Side], keys, period: str, max_rows: int) -> DataFrame | None:
    """lookup form: the left rows with a column ``_pick<i>`` per side, or None
    if a side is too large to be broadcast."""
    out = left
    for i, s in enumerate(sides):
        r = _right(s, keys).dropna(subset=list(keys))
        size = measured(r, keys)
        if size.rows > max_rows or size.bytes > DEFAULT_BROADCAST_BYTES:
            return None
        lists = r.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("_q").alias("q"), *s.values))).alias("_h"))
        out = out.join(F.broadcast(lists), list(keys), "left")
        # the number of periods <= t, built up from powers of two
        t, periods = F.col(_q(period)), F.col("_h.q")
        steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, size.longest.bit_length())))])
        n = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(periods, at + step - 1) <= t, at + step).otherwise(at))
        out = out.withColumn("_n", n)
        prev, nxt = F.get("_h", F.col("_n") - 1), F.get("_h", F.col("_n"))
        pick = (F.when(t.isNull(), F.lit(None)).when(prev.isNull(), nxt).when(nxt.isNull(), prev)
                .when(t - prev["q"] < nxt["q"] - t, prev).otherwise(nxt))
        out = out.withColumn(f"_pick{i}", pick).drop("_h", "_n")
    return out


def _answers_fill(probes: DataFrame, sides: list[Side], keys, period: str,
                  buckets: int | None, bucket_width: int | None = None, carry_left: bool = False) -> DataFrame:
    """fill form for one or more right sides in one pass.

    ``carry_left``: ``probes`` are the left rows themselves; they travel
    through the window as a struct ``_L`` (no distinct, no join back)."""
    keys = list(keys)
    n = len(sides)
    # one payload column per side; a row carries at most one non-null payload
    pay = [f"_p{i}" for i in range(n)]
    extra = [F.struct(*[F.col(_q(c)) for c in probes.columns]).alias("_L")] if carry_left else []
    prob = probes.select(*keys, F.col(period).alias("_t"), F.lit(0).alias("_r"), *extra,
                         *[F.lit(None).alias(p) for p in pay])
    # sides over the same DataFrame become payload columns of one scan
    shared: dict[int, list[int]] = {}
    for i, sd in enumerate(sides):
        shared.setdefault(id(sd.df), []).append(i)
    rights = []
    for members in shared.values():
        first = sides[members[0]]
        if any(sides[i].period != first.period for i in members):
            raise ValueError("sides sharing a DataFrame must share the period column")
        df = first.df.where(F.col(first.period).isNotNull())
        if carry_left:
            # left rows with a null key share a partition with nothing: keep
            # right rows with a null key out of it (an equi-join never matches them)
            for k in keys:
                df = df.where(F.col(k).isNotNull())
        conds = [sides[i].rows for i in members]
        if all(c is not None for c in conds):
            any_side = conds[0]
            for c in conds[1:]:
                any_side = any_side | c
            df = df.where(any_side)
        cols = []
        for j, p in enumerate(pay):
            if j in members:
                sd = sides[j]
                payload = F.struct(F.col(sd.period).alias("q"), *[F.col(v) for v in sd.values])
                cols.append((payload if sd.rows is None else F.when(sd.rows, payload)).alias(p))
            else:
                cols.append(F.lit(None).alias(p))
        rights.append(df.select(*keys, F.col(first.period).alias("_t"), F.lit(1).alias("_r"), *cols))
    # the typed union needs the payload types on every input
    types = {}
    for r in rights:
        for p in pay:
            t = r.schema[p].dataType
            if t.typeName() != "void":
                types[p] = t
    prob = prob.withColumns({p: F.lit(None).cast(types[p]) for p in pay})
    rights = [r.withColumns({p: F.col(p).cast(types[p]) for p in pay}) for r in rights]
    if carry_left:
        lt = prob.schema["_L"].dataType
        rights = [r.withColumn("_L", F.lit(None).cast(lt)) for r in rights]
    unmatched = F.col("_t").isNull()
    for k in keys:
        unmatched = unmatched | F.col(k).isNull()
    if bucket_width:
        # the caller knows the period unit: pieces of fixed width
        bucket = F.floor(F.col("_t") / F.lit(int(bucket_width))).cast("long")
        prob_bucket = bucket
        if carry_left:
            # left rows without a period or key match nothing; spread them over
            # salted negative buckets so they never gather in one window partition
            salt = F.pmod(F.xxhash64("_L"), F.lit(1024)).cast("long")
            prob_bucket = F.when(unmatched, -2 - salt).otherwise(bucket)
        prob = prob.withColumn("_b", prob_bucket)
        rights = [r.withColumn("_b", bucket) for r in rights]
    allrows = prob
    for r in rights:
        allrows = allrows.unionByName(r)
    if not bucket_width:
        allrows = _pieces(allrows, keys, [F.xxhash64("_L")] if carry_left else [], buckets)
        prob, rights = allrows.where("_r = 0"), [allrows.where("_r = 1")]

    part = keys + ["_b"]
    # right rows first at equal period, so an exact hit is "at or before"
    up = Window.partitionBy(*part).orderBy(F.col("_t").asc(), F.col("_r").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*part).orderBy(F.col("_t").desc(), F.col("_r").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = allrows.select(
        *part, "_t", "_r", *(["_L"] if carry_left else []),
        *[F.last(p, ignorenulls=True).over(up).alias(f"_prev{i}") for i, p in enumerate(pay)],
        *[F.last(p, ignorenulls=True).over(down).alias(f"_next{i}") for i, p in enumerate(pay)],
    ).where(F.col("_r") == 0)

    # Per-piece summary: the first and last right row of every piece (an
    # aggregation over the right side only), next to every piece that holds
    # probes; carried to the following / preceding pieces by a window over one
    # row per key and piece.  Built apart from the big window above, so that
    # union is shuffled and sorted once.
    rall = rights[0]
    for r in rights[1:]:
        rall = rall.unionByName(r)
    rsum = rall.groupBy(*part).agg(
        *[F.max_by(p, F.when(F.col(p).isNotNull(), F.col("_t"))).alias(f"_lastb{i}")
          for i, p in enumerate(pay)],
        *[F.min_by(p, F.when(F.col(p).isNotNull(), F.col("_t"))).alias(f"_firstb{i}")
          for i, p in enumerate(pay)])
    probe_buckets = prob.where(~unmatched).select(*part).distinct()
    summary = probe_buckets.join(rsum, part, "full")
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.col("_b").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *part,
        *[F.last(f"_lastb{i}", ignorenulls=True).over(before).alias(f"_cprev{i}") for i in range(n)],
        *[F.last(f"_firstb{i}", ignorenulls=True).over(after).alias(f"_cnext{i}") for i in range(n)])

    j = scanned.join(carry, part, "left")
    out_cols: list[Column] = ([F.col("_L")] if carry_left else
                              [*(F.col(k) for k in keys), F.col("_t").alias(period)])
    for i, s in enumerate(sides):
        prev = F.coalesce(F.col(f"_prev{i}"), F.col(f"_cprev{i}"))
        nxt = F.coalesce(F.col(f"_next{i}"), F.col(f"_cnext{i}"))
        dp = F.col("_t") - prev["q"]
        dn = nxt["q"] - F.col("_t")
        pick = (F.when(unmatched, F.lit(None)).when(prev.isNull(), nxt)
                .when(nxt.isNull(), prev).when(dp < dn, prev).otherwise(nxt))
        out_cols.append(pick.alias(f"_pick{i}"))
    return j.select(*out_cols)


def nearest_enrich(left: DataFrame, keys, period: str, sides: list[Side], form: str = "fill",
                   buckets: int | None = None, broadcast_rows: int | None = None,
                   bucket_width: int | None = None, probe_rows: str = "distinct") -> DataFrame:
    """Attach the nearest right row of each side to every left row.

    Adds ``<prefix>period`` (or ``match_period``) and ``<prefix><value>``
    per side.  ``broadcast_rows`` broadcasts the right side (window/minby) or
    its arrays (lookup, by default) when a check proves it has at most that
    many rows.  Periods are integers (years, day numbers, epoch seconds).  The
    fill form cuts the rows into ``buckets`` range pieces (by default PIECES
    times the shuffle partitions), or the period axis into pieces of
    ``bucket_width`` periods when the caller knows the unit.

    ``probe_rows`` (fill form): ``"distinct"`` probes the distinct (key,
    period) pairs and joins the answers back - safe when one pair is hot;
    ``"rows"`` sends the left rows themselves through the window - one
    read of the left side and two shuffles fewer, for panels that are
    unique (or at least not hot) per (key, period).  Same result.
    """
    if probe_rows not in ("distinct", "rows"):
        raise ValueError("probe_rows must be 'distinct' or 'rows'")
    keys = [keys] if isinstance(keys, str) else list(keys)
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}")
    picked = []
    for i, s in enumerate(sides):
        picked += [F.col(f"_pick{i}.q").alias(s.out_period()), *[F.col(f"_pick{i}.{v}").alias(s.out_value(v)) for v in s.values]]
    if form == "lookup":
        ans = _answers_lookup(left, sides, keys, period, broadcast_rows or DEFAULT_BROADCAST_ROWS)
        if ans is not None:
            return ans.select(*[F.col(_q(c)) for c in left.columns], *picked)
        form = "fill"
    if form == "fill" and probe_rows == "rows":
        ans = _answers_fill(left, sides, keys, period, buckets, bucket_width, carry_left=True)
        return ans.select(*[F.col(f"_L.{_q(c)}").alias(c) for c in left.columns], *picked)
    probes = _probes(left, keys, period)
    if form == "fill":
        ans = _answers_fill(probes, sides, keys, period, buckets, bucket_width)
        ans = ans.select(*(F.col(k) for k in keys), F.col(period), *picked)
    else:
        ans = None
        for s in sides:
            a = _answers_ranked(probes, s, keys, period, form, broadcast_rows).select(
                *keys, period, F.col("_q").alias(s.out_period()),
                *[F.col(v).alias(s.out_value(v)) for v in s.values])
            ans = a if ans is None else ans.join(a, keys + [period], "full")
    out = left.join(ans, keys + [period], "left")
    added = [c for c in ans.columns if c not in keys and c != period]
    return out.select(*[F.col(_q(c)) for c in left.columns], *[F.col(_q(c)) for c in added])


def nearest_join(left: DataFrame, right: DataFrame, keys, left_period: str, right_period: str,
                 values, form: str = "fill", prefix: str = "", **kw) -> DataFrame:
    """J4 for one right side."""
    return nearest_enrich(left, keys, left_period,
                          [Side(right, right_period, list(values), prefix)], form, **kw)
