"""A Merkle manifest of a dataset, and the proof of every document by a recursive query.

Every document is a leaf. The leaves of a source, in order of doc_id, are hashed in runs of 16, the
results again, until one is left, the source's subroot; the subroots, in order of source, give the
root the same way. Each level is written as rows that name their parent and hold the hashes of their
siblings, left and right. A recursive common table expression then climbs: a step joins the rows that
have come up so far with their node, appends its siblings to the proof and folds each leaf's hash,
tampered or not, into the parent's, until no parent is left.

The 16 leaves of a run have the same way up and the same siblings above the run, so they travel as one
row with 16 hashes. Every row passes the few top nodes, which would be one hot key a level: a node is
therefore stored once for each ``LANE`` leaves below it, and a row meets the copy of its own lane. A
leaf's place comes from prefix sums over ranges of (source, doc_id), so a source with a third of all
documents is no group anywhere. Texts are hashed where they are read and never move.

Defined results: rows with equal doc_id are leaves each for itself, in order of their hashes; a null
doc_id comes first in its source and is never tampered with; a null source is a source of its own, not
the empty one; a document alone in its source is the subroot, and one source's subroot the root; the
proof of a single document is the hash of nothing; an empty table gives no rows; columns beside the
five hashed ones are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import fresh_path, hold
from .numbering import before_ranges, laid_out
from .sizes import parts

#: consecutive nodes hashed together
RUN = 16
#: consecutive leaves that climb by the same copy of a node
LANE = RUN * 256
#: bytes of stored input whose leaves make one range
RANGE_BYTES = 16 << 20
TAMPERED_EVERY = 5
HASHED = ("doc_id", "source", "lang", "n_chars", "text")

# fixed values: the letters that tampering changes
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*columns: Column, text: Column | None = None) -> Column:
    """The leaf: sha256 over each value's length and bytes, ``-`` for a null."""
    values = [c.cast("string") for c in columns] + ([] if text is None else [text.cast("string")])
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(v), F.lit(":"), v), F.lit("-")) for v in values)), 256)


def tampered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def leaves(docs: DataFrame, every: int = TAMPERED_EVERY) -> DataFrame:
    """(doc_id, source, leaf, changed): changed is the leaf of a tampered copy, null where there is none."""
    fields = [F.col(c) for c in HASHED[:-1]]
    text = F.col("text").cast("string")
    chosen = F.crc32(F.col("doc_id").cast("string")) % every == 0
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        digest(*fields, text=text).alias("leaf"),
        F.when(chosen, digest(*fields, text=tampered(text))).alias("changed"),
    )


def _placed(rows: DataFrame, ranges: int) -> DataFrame:
    """(tree, n, idx, at, doc_id, leaf, changed): the source's number and leaves, the leaf's place in it and in all."""
    laid = laid_out(rows, ["source", "doc_id", "leaf", "changed"], ranges, "leaf-order")
    # few rows: each source once for each range it reaches into
    spread = hold(laid.groupBy("range_no", "source").agg(F.count("*").alias("n")), "source-spread")
    sources = spread.groupBy("source").agg(F.sum("n").alias("n"))
    ordered = laid_out(sources, ["source", "n"], max(1, ranges // 16), "source-order")
    starts = before_ranges(ordered, leaves="n", trees="1")
    inside = "sum(n) over (partition by range_no order by place rows between unbounded preceding and 1 preceding)"
    trees = ordered.join(starts, "range_no").select(
        F.col("source").alias("own_source"),
        F.col("n").alias("tree_n"),
        (F.col("before_trees") + F.col("place")).alias("tree"),
        (F.col("before_leaves") + F.coalesce(F.expr(inside), F.lit(0))).alias("tree_at"),
    )
    spread = spread.join(trees, F.col("source").eqNullSafe(F.col("own_source"))).join(before_ranges(laid, rows="1"), "range_no")
    spread = spread.select(F.col("range_no").alias("own_range"), "own_source", "tree", "tree_n", "tree_at", "before_rows")
    met = (F.col("range_no") == F.col("own_range")) & F.col("source").eqNullSafe(F.col("own_source"))
    at = F.col("before_rows") + F.col("place")
    return laid.join(spread, met).select("tree", F.col("tree_n").alias("n"), (at - F.col("tree_at")).alias("idx"), at.alias("at"), "doc_id", "leaf", "changed")


def _runs(placed: DataFrame, run: int) -> DataFrame:
    """One row for each run of leaves, with the id and hash of the node that it makes."""
    leaf = F.struct("idx", "doc_id", "leaf", "changed")
    runs = placed.withColumn("run", F.expr(f"idx div {run}")).groupBy("tree", "n", "run")
    runs = runs.agg(F.array_sort(F.collect_list(leaf)).alias("leaves"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    alone = F.col("n") == 1
    level = F.when(alone, 0).otherwise(1)
    return runs.select(
        "tree",
        F.concat_ws("/", "tree", level, "run").alias("id"),
        level.alias("level"),
        F.col("run").alias("idx"),
        F.ceil(F.col("n") / run).alias("n"),
        F.when(alone, F.col("leaves.leaf")[0]).otherwise(F.sha2(F.array_join("leaves.leaf", ""), 256)).alias("hash"),
        "lo",
        "hi",
        "leaves",
    )


_LINK = "id string, parent string, hash string, subroot boolean, to_left string, to_right string, lane bigint"
_NODE = ["tree", "id", "level", "idx", "n", "hash", "lo", "hi"]


class Levels:
    """The built levels of a manifest: node rows linked to their parents, below one path."""

    def __init__(self, spark: SparkSession, run: int, lane: int):
        self.spark, self.run, self.lane = spark, run, lane
        self.path = fresh_path(spark, "merkle-nodes")

        spark.createDataFrame([], _LINK).write.parquet(self.path)

    def nodes(self) -> DataFrame:
        return self.spark.read.schema(_LINK).parquet(self.path)

    def _link(self, groups: DataFrame, parent: Column, subroot: Column) -> None:
        """Write the kids of each parent, with their siblings, once a lane."""
        kid = groups.select(parent.alias("parent"), subroot.alias("subroot"), F.posexplode("kids").alias("p", "kid"), F.col("kids.hash").alias("all"))
        lanes = F.sequence(F.expr(f"kid.lo div {self.lane}"), F.expr(f"kid.hi div {self.lane}"))
        rows = kid.select(
            F.col("kid.id").alias("id"),
            "parent",
            F.col("kid.hash").alias("hash"),
            "subroot",
            F.array_join(F.slice("all", F.lit(1), F.col("p")), "").alias("to_left"),
            F.array_join(F.slice("all", F.col("p") + 2, F.lit(self.run)), "").alias("to_right"),
            F.explode(lanes).alias("lane"),
        )
        rows.write.mode("append").parquet(self.path)

    def build(self, nodes: DataFrame, name: Column, subroot: Column) -> DataFrame:
        """Hash nodes in runs, tree by tree, until each tree is one node; those are returned."""
        tops, current = [], nodes.select(_NODE)
        while True:
            tops.append(current.where("n = 1"))
            level = current.where("n > 1")
            if level.isEmpty():
                break
            kid = F.struct("idx", "id", "hash", "lo", "hi")
            groups = level.withColumn("up", F.expr(f"idx div {self.run}")).groupBy("tree", "level", "n", "up").agg(F.array_sort(F.collect_list(kid)).alias("kids"))
            parent = F.concat_ws("/", name, F.col("level") + 1, "up")
            groups = hold(groups, "merkle-level")
            self._link(groups, parent, subroot)
            current = groups.select(
                "tree",
                parent.alias("id"),
                (F.col("level") + 1).alias("level"),
                F.col("up").alias("idx"),
                F.ceil(F.col("n") / self.run).alias("n"),
                F.sha2(F.array_join("kids.hash", ""), 256).alias("hash"),
                F.array_min("kids.lo").alias("lo"),
                F.array_max("kids.hi").alias("hi"),
            )
        whole = tops[0]
        for top in tops[1:]:
            whole = whole.unionByName(top)
        return whole


_CLIMB = """
with recursive climb(start, id, lane, subroot, proof, folded) as (
  select id, id, lane, cast(null as string), '', folded from {runs}
  union all
  select c.start, n.parent, c.lane, if(n.subroot, n.hash, c.subroot), concat(c.proof, n.to_left, n.to_right),
    transform(c.folded, f -> sha2(concat(n.to_left, f, n.to_right), 256))
  from climb c join {nodes} n on c.id = n.id and c.lane = n.lane
)
select start, subroot, proof, folded from climb where id = {root}"""

#: the session's bound on a recursion's rows, 1 million unless set; here they grow with the documents
_ROWS = "spark.sql.cteRecursionRowLimit"


def _climbed(spark: SparkSession, runs: DataFrame, nodes: DataFrame, root_id: str) -> DataFrame:
    """(start, subroot, proof, folded) of every run that has reached the root."""
    before = spark.conf.get(_ROWS)
    spark.conf.set(_ROWS, "-1")
    try:
        return hold(spark.sql(_CLIMB, runs=runs.select("id", "lane", "folded"), nodes=nodes, root=root_id), "merkle-climb")
    finally:
        spark.conf.set(_ROWS, before)


def proofs(docs: DataFrame, every: int = TAMPERED_EVERY, run: int = RUN, lane: int = LANE, ranges: int | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root, verified); proof is the siblings' hashes, run together."""
    spark = docs.sparkSession
    # stored first: ranges are found by a sample, which would hash the texts twice
    rows = hold(leaves(docs, every), "leaves")
    own = lambda x: F.coalesce(x["changed"], x["leaf"])
    hashes = F.col("leaves.leaf")
    beside = lambda p: (F.array_join(F.slice(hashes, F.lit(1), p), ""), F.array_join(F.slice(hashes, p + 2, F.lit(run)), ""))

    def first(x, p):
        left, right = beside(p)
        return F.when(F.col("level") == 0, own(x)).otherwise(F.sha2(F.concat(left, own(x), right), 256))

    runs = _runs(_placed(rows, ranges or parts(docs, RANGE_BYTES)), run)
    runs = hold(runs.withColumn("folded", F.transform("leaves", first)).withColumn("lane", F.expr(f"lo div {lane}")), "merkle-runs")
    levels = Levels(spark, run, lane)
    subroots = hold(levels.build(runs, F.col("tree"), F.lit(False)), "subroots")
    trees = subroots.count()
    above = subroots.select(F.lit(0).cast("bigint").alias("tree"), "id", F.lit(0).alias("level"), F.col("tree").alias("idx"), F.lit(trees).cast("bigint").alias("n"), "hash", "lo", "hi")
    top = levels.build(above, F.lit("top"), F.col("level") == 0).first()
    root, root_id = (top["hash"], top["id"]) if top else ("", "")
    risen = _climbed(spark, runs, levels.nodes(), root_id)
    kid = risen.join(runs.select("id", "leaves"), F.col("start") == F.col("id")).select("subroot", "proof", "folded", hashes.alias("all"), F.posexplode("leaves").alias("p", "x"))
    left, right = (F.array_join(F.slice("all", *x), "") for x in ((F.lit(1), F.col("p")), (F.col("p") + 2, F.lit(run))))
    return kid.select(
        "x.doc_id",
        "x.leaf",
        F.coalesce("subroot", F.lit(root)).alias("subroot"),
        F.lit(root).alias("root"),
        F.concat(left, right, "proof").alias("proof"),
        F.col("folded")[F.col("p")].alias("folded_root"),
        (F.col("folded")[F.col("p")] == root).alias("verified"),
    )
