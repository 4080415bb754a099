"""Merkle manifest of a dataset: a tree per group, a tree over the groups, and proofs by pointer jumping."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from inkloom.llm.tables import written

FAN = 3  # nodes of a run
ROWS_PER_RANGE = 200_000  # leaves numbered by one task
TOP = ""  # name of the tree over the groups; those of groups begin with a sign
PATH = "array<struct<place: int, siblings: binary>>"


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 (lowercase hex) of the values: ``-`` for a null, else the UTF-8 byte count, ``:`` and the value as text."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(c) for c in columns]).cast("binary"), 256)


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _joined_digest(digests: Column) -> Column:
    """Digest of the digests written as hex one after another."""
    return F.unhex(F.sha2(_hex(digests).cast("binary"), 256))


def numbered(leaves: DataFrame, order: list[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The rows with ``index``, their place from 0 within their ``tree``, and ``n``, the rows of that tree.

    Rows are cut into ranges of (tree, order) of about equal counts, whatever
    tree they belong to, and numbered within each; what a tree has in earlier
    ranges is added.  The ranges are a written table, so a lost executor does not
    change them; per tree and range one row of counts is kept.
    """
    ranges = -(-leaves.count() // rows_per_range) or 1
    keys = ["tree", *order]
    cut = leaves.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    rows = written(cut.withColumn("at", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("range", F.shiftright("at", 33))
    counts = rows.groupBy("tree", "range").agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("here"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"before": F.coalesce(F.sum("here").over(earlier), F.lit(0)), "n": F.sum("here").over(tree)})
    placed = rows.join(counts, ["tree", "range"])
    return placed.withColumn("index", col("at") - col("begin") + col("before")).drop("at", "range", "begin", "here", "before")


def _runs(nodes: DataFrame, levels: int, fan: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(runs, tops) of the trees over ``nodes`` (tree, index, n, digest).

    A run (tree, level, parent, members) is up to ``fan`` neighbouring nodes of a
    level; their joined digest is the node ``parent`` of the next one.  A level
    is one grouping of the nodes below it, written, so a lost executor costs one
    level.  ``tops`` (tree, level, digest) has the node that remains of each tree.
    """
    runs, tops = [], []
    for level in range(levels + 1):
        tops.append(nodes.where("n = 1").select("tree", F.lit(level).alias("level"), "digest"))
        if level == levels:
            break
        members = F.array_sort(F.collect_list(F.struct("index", "digest")))  # a run is bounded by the fan
        run = nodes.where("n > 1").groupBy("tree", F.expr(f"index div {fan}").alias("parent"))
        run = run.agg(members.alias("members"), F.max("n").alias("n")).withColumn("level", F.lit(level))
        run = written(run, f"{name}-runs")
        runs.append(run)
        joined = F.aggregate("members", F.lit("").cast("binary"), lambda done, m: F.concat(done, m["digest"]))
        upper = F.expr(f"(n + {fan - 1}) div {fan}").alias("n")
        nodes = run.select("tree", col("parent").alias("index"), upper, _joined_digest(joined).alias("digest"))
    whole = tops[0]
    for part in tops[1:]:
        whole = whole.unionByName(part)
    every = None
    for part in runs:
        every = part if every is None else every.unionByName(part)
    return every, written(whole, f"{name}-tops")


def _levels(n: int, fan: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // fan), levels + 1
    return levels


def _steps(runs: DataFrame | None, spark: SparkSession, base: int) -> DataFrame:
    """(node, above, path): each node of the runs, its parent, and its siblings as a path of one step.

    A node is named by (tree, level, index), levels counted from ``base``; a step
    is the place in the run and the digests of the others, left to right.
    """
    if runs is None:
        name = "struct<tree: string, level: int, index: long>"
        return spark.createDataFrame([], f"node {name}, above {name}, path {PATH}")
    others = lambda m: F.aggregate(
        F.filter("members", lambda o: o["index"] != m["index"]), F.lit("").cast("binary"), lambda done, o: F.concat(done, o["digest"])
    )
    first = F.get("members", F.lit(0))["index"]
    steps = F.transform(
        "members",
        lambda m: F.struct(
            m["index"].alias("index"), (m["index"] - first).cast("int").alias("place"), others(m).alias("siblings")
        ),
    )
    rows = runs.select("tree", "level", "parent", F.explode(steps).alias("step"))
    return rows.select(
        F.struct("tree", (col("level") + base).alias("level"), col("step.index").alias("index")).alias("node"),
        F.struct("tree", (col("level") + base + 1).alias("level"), col("parent").alias("index")).alias("above"),
        F.array(F.struct("step.place", "step.siblings")).cast(PATH).alias("path"),
    )


def _jump(steps: DataFrame, root: Column, longest: int) -> DataFrame:
    """(node, path) with each leaf's path lengthened to the root, by pointer jumping.

    Each round joins the table with itself: a node takes the path of the ancestor
    it has reached and points to that one's ancestor, so distances double, and
    as many rounds do as the logarithm of the longest path.  Nodes at the root
    leave the join.  A path of d steps ends at level d or above, so each round
    keeps leaves and the levels that later rounds can reach: ancestors thin out,
    the planner broadcasts them once they are few and splits hot ones before.
    """
    at_root = col("above") == root
    going, done, distance = written(steps, "paths"), steps.limit(0), 1
    while distance < longest:
        every = going.unionByName(done)
        ends = every.where(col("node.level") >= distance)
        ends = ends.select(col("node").alias("above"), col("above").alias("next"), col("path").alias("rest"))
        met = going.where(~at_root & ((col("node.level") == 0) | (col("node.level") >= 2 * distance))).join(ends, "above")
        done = done.unionByName(going.where(at_root))
        going = written(met.select("node", col("next").alias("above"), F.concat("path", "rest").alias("path")), "paths")
        distance *= 2
    return going.unionByName(done).where(col("node.level") == 0).select("node", "path")


@dataclass
class Manifest:
    """``leaves``: tree, index, leaf, path, subroot and the carried columns of each row; ``root``: hex digest, null without rows."""

    leaves: DataFrame
    root: str | None


def build_manifest(
    docs: DataFrame,
    leaf: Column,
    group_column: str = "source",
    id_column: str = "doc_id",
    carry: tuple[str, ...] = (),
    fan: int = FAN,
    rows_per_range: int = ROWS_PER_RANGE,
) -> Manifest:
    """Hash trees over the rows of each group, one over the groups, and each row's proof.

    ``leaf`` is the hex digest of a row (see ``leaf_digest``).  Within a group
    leaves ascend by id, a null id first and equal ids by their digest; every
    ``fan`` neighbours become one node until one remains, the subroot.  Groups
    ascend by their name's bytes, the null group first.  Repeated rows are leaves
    each for itself; null and empty texts are values like others; an empty table
    has no leaves and no root.  The result has the columns ``id_column`` and
    ``carry`` of ``docs``, ``leaf``, ``subroot`` and ``path`` (see ``PATH``) only, so other
    columns may have any name; the carried ones must not have these names.

    Texts are read once and never shuffled.  A hot group is cut into ranges like
    any other rows; all tables that the steps share are written.
    """
    kept = {f"c{i}": col(f"`{name}`") for i, name in enumerate((id_column, *carry))}
    tree = F.coalesce(F.concat(F.lit("="), col(f"`{group_column}`").cast("string")), F.lit("-"))
    rows = docs.select(tree.alias("tree"), F.unhex(leaf).alias("digest"), *[c.alias(n) for n, c in kept.items()])
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    leaves = written(numbered(rows, ["c0", "digest", "row"], rows_per_range).drop("row"), "placed")
    largest = leaves.agg(F.max("n")).first()[0]
    names = [id_column, *carry]
    if largest is None:
        empty = leaves.select(*[col(f"c{i}").alias(n) for i, n in enumerate(names)], F.lit("").alias("leaf"), F.lit("").alias("subroot"))
        return Manifest(empty.withColumn("path", F.array().cast(PATH)), None)
    depth = _levels(largest, fan)
    runs, tops = _runs(leaves.select("tree", "index", "n", "digest"), depth, fan, "group")
    groups = numbered(tops.select(col("tree").alias("group"), "level", "digest").withColumn("tree", F.lit(TOP)), ["group"], rows_per_range)
    groups = written(groups, "groups")
    width = _levels(groups.count(), fan)
    top_runs, top = _runs(groups.select("tree", "index", "n", "digest"), width, fan, "top")
    steps = _steps(runs, leaves.sparkSession, 0)
    # the top tree stands on the groups' last nodes
    upper = _steps(top_runs, leaves.sparkSession, depth)
    subroot = F.struct(col("group").alias("tree"), "level", F.lit(0).cast("long").alias("index")).alias("lower")
    at_top = groups.select(F.struct("tree", F.lit(depth).alias("level"), "index").alias("node"), subroot)
    upper = upper.join(at_top, "node", "left").select(F.coalesce("lower", "node").alias("node"), "above", "path")
    if width:
        root = F.struct(F.lit(TOP), F.lit(depth + width), F.lit(0).cast("long"))
    else:
        root = F.struct(F.lit(groups.first()["group"]), F.lit(depth), F.lit(0).cast("long"))
    paths = _jump(steps.unionByName(upper), root, depth + width)
    own = paths.where(col("node.tree") != TOP).select("node.tree", "node.index", "path")
    subroots = tops.select("tree", _hex(col("digest")).alias("subroot"))
    result = leaves.join(own, ["tree", "index"], "left").join(subroots, "tree")
    result = result.select(
        *[col(f"c{i}").alias(n) for i, n in enumerate(names)], _hex(col("digest")).alias("leaf"), "subroot",
        F.coalesce("path", F.array().cast(PATH)).alias("path"),
    )
    return Manifest(result, top.select(_hex(col("digest"))).first()[0])


def _siblings_hex(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda step: _hex(step["siblings"])), "")


def proof_digest(path: Column) -> Column:
    """Digest (hex) of a proof: all its siblings, level by level, left to right."""
    return F.sha2(_siblings_hex(path).cast("binary"), 256)


def folded_root(leaf: Column, path: Column) -> Column:
    """The root (hex) that a leaf's digest gives with the siblings of its path."""

    def up(digest: Column, step: Column) -> Column:
        others = _hex(step["siblings"])
        before = 64 * step["place"]  # hex digits left of the node
        return F.sha2(F.concat(F.substr(others, F.lit(1), before), digest, F.substr(others, before + 1)).cast("binary"), 256)

    return F.aggregate(path, leaf, up)
