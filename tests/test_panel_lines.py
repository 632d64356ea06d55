"""The line totals behind the panel joins: tasks grow in number, not in size."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

from strata.plans import q_panel


def test_partitions_follow_the_lines(spark, tmp_path, monkeypatch):
    rng, day = random.Random(3), dt.datetime(1995, 1, 1)
    owner = {k: rng.randrange(40) if k % 17 else None for k in range(300)}
    lines = [(rng.randrange(310) if i % 23 else None, round(rng.random() * 100, 2), day + dt.timedelta(rng.randrange(900)) if i % 19 else None)
             for i in range(2000)] + [(7, 1.25, day)] * 500
    spark.createDataFrame(lines, "l_orderkey long, l_extendedprice double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(list(owner.items()), "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    want = defaultdict(Decimal)
    for order, price, shipped in lines:
        if order in owner:
            want[owner[order], shipped and shipped.year] += Decimal(str(price))
    monkeypatch.setattr(q_panel, "LINES_PER_TASK", 60)
    out = q_panel._line_totals(spark, str(tmp_path))
    assert {(r.o_custkey, r.year): r.line_total for r in out.collect()} == {k: float(v) for k, v in want.items()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    for key in ("l_orderkey", "o_orderkey"):
        assert [s for s in plan.splitlines() if f"hashpartitioning({key}#" in s and ", 42)" in s], plan
