"""A Merkle manifest of a dataset, and proofs by a recursive climb.

The rows are leaves.  Per source they ascend by id; every 16 consecutive
nodes become one parent until one node, the subroot, is left; the subroots,
ordered by source, become the root in the same way.  A digest is the
lowercase hex SHA-256 of its inputs put together.

The levels are built one after another and stored as parent-linked rows::

    (tree, level, no) -> digest, children, ordinal, (p_tree, p_level, p_no)

A recursive query of Spark then ascends from the leaves: each step joins the
parent's row, appends the siblings that stand in ``children`` beside the node
and folds every leaf's own digest into the parent's.  The leaves of one run
of 16 have the rest of their way in common, so they climb as one row that
holds a folded digest for each and the siblings once.

A high node is the parent of very many climbing rows.  Its row is there once
for every ``RUNS_PER_COPY`` runs below it, and a climbing row joins the copy
its hash names, so no key of the join holds more than about that many rows.
Leaf numbers come from one range partitioning and one row per task and
source; nothing but the number of leaves of the largest source and the
number of sources reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.session import materialize

FANOUT = 16             # children of a node; ``SHIFT`` bits of a node's number
SHIFT = 4
DIGEST = 64             # characters of a digest
RUNS_PER_COPY = 4096
TOP = -1                # the tree over the subroots


def row_digest(columns: list[Column]) -> Column:
    """Digest of a row: of each value ``-`` if null, else the UTF-8 length of
    its text, a colon and the text."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def _numbered(leaves: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, found) with the leaf's number in its source
    (``no``), the source's number (``tree``) and its leaves (``n``)."""
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["source", "doc_id", "leaf", "found"]
    placed = materialize(leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .withColumn("at", F.monotonically_increasing_id())
                         .withColumn("part", F.shiftright("at", 33)), "merkle-order")
    heads = materialize(placed.groupBy("part", "source").agg(F.min("at").alias("first"), F.count("*").alias("rows")), "merkle-heads")
    heads = (heads.withColumn("before", F.sum("rows").over(W.partitionBy("source").orderBy("part")) - F.col("rows"))
             .withColumn("n", F.sum("rows").over(W.partitionBy("source")))
             .withColumn("begun", F.sum((F.col("before") == 0).cast("long")).over(W.partitionBy("part").orderBy("first"))))
    # one row per task: the sources that begin in earlier tasks
    tasks = heads.groupBy("part").agg(F.max("begun").alias("here"))
    tasks = tasks.select(F.col("part").alias("task"), (F.sum("here").over(W.orderBy("part")) - F.col("here")).alias("earlier"))
    heads = (heads.join(tasks, F.col("part") == F.col("task"))
             .select(F.col("part").alias("p"), F.col("source").alias("name"), "first", "before", "n",
                     (F.col("earlier") + F.col("begun") - 1).alias("tree")))
    return (placed.join(heads, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("name")))
            .select("tree", "n", (F.col("before") + F.col("at") - F.col("first")).alias("no"), "doc_id", "leaf", "found"))


def _beside(children: Column, ordinal: Column) -> tuple[Column, Column]:
    """The digests before and after the ordinal-th in ``children``."""
    return children.substr(F.lit(1), ordinal * DIGEST), children.substr(ordinal * DIGEST + DIGEST + 1, F.length(children))


def _runs(leaves: DataFrame) -> DataFrame:
    """One row per run of leaves: its members, their digests put together,
    its own digest and, per member, the run's digest folded from what was
    found.  A source's only leaf is a run that is not hashed again."""
    run = F.shiftright("no", SHIFT)
    rows = (leaves.groupBy("tree", "n", run.alias("run"))
            .agg(F.array_sort(F.collect_list(F.struct("no", "doc_id", "leaf", "found"))).alias("members")))
    rows = rows.withColumn("children", F.array_join("members.leaf", ""))

    def fold(m: Column, i: Column) -> Column:
        left, right = _beside(F.col("children"), i)
        return F.when(F.col("n") == 1, m["found"]).otherwise(F.sha2(F.concat(left, m["found"], right), 256))

    return rows.select("tree", "run", "n", "children",
                       F.when(F.col("n") == 1, F.col("children")).otherwise(F.sha2("children", 256)).alias("digest"),
                       F.transform("members", fold).alias("folded"),
                       F.transform("members", lambda m: F.struct(m["doc_id"], m["leaf"])).alias("members"))


def _linked(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of one level with the link to their parents; ``grp`` and ``at``
    say where a node stands among those that are put together."""
    p_no = F.shiftright("at", SHIFT)
    return materialize(nodes.withColumn("p_no", p_no).withColumn("ordinal", (F.col("at") % FANOUT).cast("int"))
                       .withColumn("p_level", F.lit(level + 1))
                       .withColumn("p_runs", F.sum("runs").over(W.partitionBy("grp", "p_no")))
                       .withColumn("p_tree", F.col("grp")), "merkle-level")


def _parents(linked: DataFrame) -> DataFrame:
    up = linked.groupBy("p_tree", "p_level", "p_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "digest"))), lambda c: c["digest"]), "").alias("children"),
        F.sum("runs").alias("runs"), F.first("n").alias("n"))
    return up.select(F.col("p_tree").alias("tree"), F.col("p_level").alias("level"), F.col("p_no").alias("no"),
                     F.col("p_tree").alias("grp"), F.col("p_no").alias("at"), F.ceil(F.col("n") / FANOUT).alias("n"),
                     F.sha2("children", 256).alias("digest"), "children", "runs", F.lit(None).cast("array<string>").alias("folded"))


def _tree(runs: DataFrame) -> DataFrame:
    """Parent-linked rows of all nodes from the runs up to the root."""
    base = runs.select("tree", F.when(F.col("n") == 1, 0).otherwise(1).alias("level"), F.col("run").alias("no"),
                       F.col("tree").alias("grp"), F.col("run").alias("at"), F.ceil(F.col("n") / FANOUT).alias("n"),
                       "digest", "children", F.lit(1).cast("long").alias("runs"), "folded")
    found = base.agg(F.max("n").alias("widest"), F.max("tree").alias("last")).first()
    widest, sources = found.widest or 0, (-1 if found.last is None else found.last) + 1
    stored, roots, nodes, level = [], base.where("n = 1"), base.where("n > 1"), 1
    while widest > 1:
        stored.append(_linked(nodes, level))
        up = _parents(stored[-1])
        roots, nodes = roots.union(up.where("n = 1")), up.where("n > 1")
        widest, level = -(-widest // FANOUT), level + 1
    nodes = roots.withColumn("grp", F.lit(TOP).cast("long")).withColumn("at", F.col("tree")).withColumn("n", F.lit(sources).cast("long"))
    level = 0
    while sources > 1:
        stored.append(_linked(nodes, level))
        nodes = _parents(stored[-1])
        sources, level = -(-sources // FANOUT), level + 1
    root = _linked(nodes, level)
    stored.append(root.withColumns({c: F.lit(None).cast(t) for c, t in root.dtypes if c in ("p_tree", "p_level", "p_no", "ordinal", "p_runs")}))
    every = stored[0]
    for s in stored[1:]:
        every = every.union(s)
    return every.drop("grp", "at", "n")


CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT tree AS from_tree, no AS from_run, folded, string('') AS proof, digest AS root,
         CASE WHEN p_tree IS NULL OR p_tree <> tree THEN digest END AS subroot, p_tree, p_level, p_no, ordinal,
         pmod(xxhash64(tree, no), ceil(p_runs / {RUNS_PER_COPY})) AS salt
  FROM {{base}}
  UNION ALL
  SELECT c.from_tree, c.from_run,
         transform(c.folded, h -> sha2(concat(left(n.children, {DIGEST} * c.ordinal), h, substring(n.children, {DIGEST} * c.ordinal + {DIGEST + 1})), 256)),
         concat(c.proof, left(n.children, {DIGEST} * c.ordinal), substring(n.children, {DIGEST} * c.ordinal + {DIGEST + 1})), n.digest,
         coalesce(c.subroot, CASE WHEN n.p_tree IS NULL OR n.p_tree <> n.tree THEN n.digest END), n.p_tree, n.p_level, n.p_no, n.ordinal,
         pmod(xxhash64(c.from_tree, c.from_run), ceil(n.p_runs / {RUNS_PER_COPY}))
  FROM climb c JOIN {{copies}} n ON n.tree = c.p_tree AND n.level = c.p_level AND n.no = c.p_no AND n.salt = c.salt
)
SELECT from_tree, from_run, folded, proof, subroot, root FROM climb WHERE p_tree IS NULL"""


@contextmanager
def _no_row_limit(spark: SparkSession) -> Iterator[None]:
    """Spark ends a recursion at a million rows unless told otherwise."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def merkle_manifest(df: DataFrame, columns: list[str], found: dict[str, Column] | None = None,
                    id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root, verified), one row
    per input row.

    ``columns`` make the leaf, in this order.  ``found`` replaces some of them
    by what is found of the row when it is checked; ``folded_root`` is the root
    recomputed from that and the row's original siblings, ``verified`` whether
    it is the root.  ``proof`` holds the siblings' digests put together, from
    the leaf's run to the root, left to right.

    A null value has its own mark; a null id comes before the others, a null
    source is a source of its own, the first.  Rows with equal ids stand in
    the order of their digests; repeated rows are leaves like any other.  An
    empty table gives no rows.  Other columns are not read.
    """
    col = lambda c: F.col(f"`{c}`")                                                                     # noqa: E731
    now = [(found or {}).get(c, col(c)) for c in columns]
    leaves = materialize(df.select(col(source_col).alias("source"), col(id_col).alias("doc_id"),
                                   row_digest([col(c) for c in columns]).alias("leaf"), row_digest(now).alias("found")), "merkle-leaves")
    runs = materialize(_runs(_numbered(leaves)), "merkle-runs")
    nodes = _tree(runs)
    base = nodes.where("folded is not null")
    copies = (nodes.where("folded is null").drop("folded")
              .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("runs") / RUNS_PER_COPY) - 1))))
    spark = df.sparkSession
    with _no_row_limit(spark):
        climbed = materialize(spark.sql(CLIMB, base=base, copies=copies), "merkle-climb")
    rows = (runs.select("tree", "run", "children", "members")
            .join(climbed, (F.col("tree") == F.col("from_tree")) & (F.col("run") == F.col("from_run")))
            .select("children", "folded", "proof", "subroot", "root", F.posexplode("members").alias("i", "m")))
    left, right = _beside(F.col("children"), F.col("i"))
    folded = F.col("folded")[F.col("i")]
    return rows.select("m.doc_id", "m.leaf", "subroot", "root", F.concat(left, right, "proof").alias("proof"),
                       folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


def lowered_where_due(text: str = "text", id_col: str = "doc_id") -> Column:
    """The text with A-Z in lower case where 5 divides the unsigned CRC-32 of
    the decimal id; any other text, and that of a null id, as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    due = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0
    return F.when(due, F.translate(F.col(f"`{text}`"), upper, upper.lower())).otherwise(F.col(f"`{text}`"))
