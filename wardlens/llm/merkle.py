"""Merkle manifest of a dataset by sibling-shift self-joins (operator 12).

Every row is a leaf. The leaves of a group ascend by id; ``fanout`` consecutive
nodes become one parent until a single node, the group's subroot, is left; the
subroots, in group order, make the root the same way.

A level is one self-join: a node's siblings have computed places (its run's
first place plus a slot offset), so the slot-zero rows ask for the places of
their run, the nodes answer by an equijoin on (group, place), and each
slot-zero row emits the parent of what came back. A join key names one node, so
a group with most of the rows is spread like any other. Proofs come from the
runs of all levels, joined downwards: a leaf's path is one (left, right) pair
of sibling digests per level, shared by the leaves of a run until the last join.
The driver learns two counts only, the largest group's rows and the groups. Everything runs as
DataFrame expressions.

Defined results: null fields hash as ``-``; a null group is a group of its own
and comes first; null ids come first in their group, equal ids follow the order
of their leaves (repeated rows give equal leaves, each with its own proof); an
empty table gives no rows; an empty text is a value of 0 bytes; columns that are not
named are not read, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.common import materialize, shuffle_partitions
from wardlens.plans.ordering import global_positions, range_sliced

FANOUT = 8
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated as text."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """A field as text: its UTF-8 byte count, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    """The leaf of a row with these fields."""
    return digest(*[framed(f) for f in fields])


def _group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does, null first."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def _placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (key, id, hash, uid, ...) with ``idx``, the place in the key's order, and ``n``, the key's rows.

    Slices of the whole order are numbered on their own and shifted by what the
    key holds in earlier slices (one row per slice and key in it).
    """
    cols = [c for c in leaves.columns if c != "uid"]
    order = ["key", "id", "hash", "uid"]
    sliced = range_sliced(leaves, order, shuffle_partitions(leaves.sparkSession), "leaf-slices")
    held = sliced.groupBy("_wl_b", "key").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("key").orderBy("_wl_b")
    held = materialize(held.select(
        "_wl_b", "key", (F.sum("c").over(w) - F.col("c")).alias("before"),
        F.sum("c").over(Window.partitionBy("key")).alias("n")), "leaf-offsets")
    local = sliced.withColumn("i", F.row_number().over(
        Window.partitionBy("_wl_b", "key").orderBy("id", "hash", "uid")) - 1)
    return materialize(local.join(held, ["_wl_b", "key"]).select(
        *cols, (F.col("before") + F.col("i")).alias("idx"), "n"), "leaves")


def _tree(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """Run tables (key, run, members, n) from the leaves up, and the last node (key, hash) of each key.

    ``nodes`` holds key, idx, n and hash. A key takes part in a level while it
    has more than one node there.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    nodes = nodes.select("key", "idx", "n", "hash")
    runs, tops = [], nodes.where("n = 1").select("key", "hash")
    while most > 1:
        many = nodes.where("n > 1")
        wanted = (many.where(F.col("idx") % fanout == 0)
                  .select("key", "n", F.col("idx").alias("zero"), F.explode(F.sequence(F.lit(0), F.lit(fanout - 1))).alias("slot"))
                  .withColumn("idx", F.col("zero") + F.col("slot")).where("idx < n"))
        found = wanted.join(many.select("key", "idx", "hash"), ["key", "idx"])
        level = found.groupBy("key", "zero", "n").agg(
            F.array_sort(F.collect_list(F.struct("slot", "hash"))).getField("hash").alias("members")).select(
            "key", F.expr(f"zero div {fanout}").alias("run"), "members", "n")
        level = materialize(level, "runs")
        runs.append(level)
        nodes = level.select("key", F.col("run").alias("idx"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
                             digest(F.array_join("members", "")).alias("hash"))
        tops = tops.unionByName(nodes.where("n = 1").select("key", "hash"))
        most = -(-most // fanout)
    return runs, tops


def _step(members: Column, slot: Column, fanout: int) -> Column:
    """The siblings of the member at ``slot``, left and right of it."""
    one = F.lit(1).cast("int")
    return F.struct(F.array_join(F.slice(members, one, slot), "").alias("left"),
                    F.array_join(F.slice(members, slot + 2, F.lit(fanout)), "").alias("right"))


def _with_paths(nodes: DataFrame, runs: Sequence[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with ``path``, their (left, right) siblings level by level, and the columns of ``tops``.

    ``tops`` has one row per key: the path from the key's last node on (``up``)
    and whatever else its nodes are to carry.
    """
    carried = [c for c in tops.columns if c != "key"]

    def climb(rows: DataFrame, place: str, above: DataFrame) -> DataFrame:
        """Rows whose level has more than one node, with the path from their run upwards."""
        slot = (F.col(place) % fanout).cast("int")
        up = above.select("key", F.col("run").alias("_run"), F.col("members").alias("_m"), *carried)
        joined = rows.withColumn("_run", F.expr(f"{place} div {fanout}")).join(up, ["key", "_run"])
        return joined.withColumn("up", F.concat(F.array(_step(F.col("_m"), slot, fanout)), F.col("up"))).drop("_run", "_m")

    above = None
    for level in reversed(runs):  # a key's last run hangs on its top, the others on the level above
        last = level.where(F.col("n") <= fanout).join(tops, "key")
        above = last if above is None else last.unionByName(climb(level.where(F.col("n") > fanout), "run", above))
    alone = nodes.where("n = 1").join(tops, "key")
    joined = alone if above is None else alone.unionByName(climb(nodes.where("n > 1"), "idx", above))
    return joined.withColumnRenamed("up", "path")


def manifest(rows: DataFrame, fields: Sequence[str], *, id_col: str, group_col: str, fanout: int = FANOUT,
             altered: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """Every row's leaf, subroot, root and path to the root.

    Columns: ``id``, ``leaf``, ``altered_leaf``, ``subroot``, ``root``, ``path``
    (array of the left and right sibling digests, from the leaf's level to the
    root's). ``altered`` gives other values for some fields; rows for which
    ``when`` holds get the leaf of these as ``altered_leaf`` (null elsewhere).
    """
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    own = [F.col(f) for f in fields]
    changed = leaf_digest(*[(altered or {}).get(f, F.col(f)) for f in fields])
    leaves = rows.select(
        _group_key(F.col(group_col)).alias("key"), F.col(id_col).alias("id"), leaf_digest(*own).alias("hash"),
        F.when(when if when is not None else F.lit(False), changed).alias("altered_leaf"))
    leaves = materialize(leaves.withColumn("uid", F.monotonically_increasing_id()), "leaf-digests")
    nodes = _placed(leaves)
    runs, tops = _tree(nodes, fanout)

    tops = materialize(tops, "subroots")
    groups = materialize(global_positions(tops, ["key"], "idx").select(
        F.lit("").alias("key"), F.col("key").alias("name"), "idx", F.lit(tops.count()).cast("long").alias("n"), "hash"), "groups")
    upper, root = _tree(groups, fanout)
    root = root.select("key", F.array().cast(_PATH).alias("up"), F.col("hash").alias("root"))
    subroots = _with_paths(groups, upper, root, fanout).select(
        F.col("name").alias("key"), F.col("path").alias("up"), F.col("hash").alias("subroot"), "root")
    subroots = materialize(subroots, "subroot-paths")
    return _with_paths(nodes, runs, subroots, fanout).select(
        "id", F.col("hash").alias("leaf"), "altered_leaf", "subroot", "root", "path")


def proof_text(path: Column) -> Column:
    """The digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda acc, x: digest(x["left"], acc, x["right"]))
