"""Hard-negative mining by coordinate pruning over length buckets (operator 11).

For every anchor: the best rows of its own label (positives), then for each
positive the best rows of other labels whose score lies between two shares of
the positive's score (negatives). A score is the inner product of integer
vectors, so every comparison is exact.

Rows of a label are sorted by length (the vector's norm), longest first, and cut
into buckets of ``BUCKET`` rows. A bucket stores its vectors and, for each
coordinate, the order of the normalised values (a sorted coordinate list).
Anchors come in blocks of ``ANCHORS``. A cell is one block and one bucket:

* a cell is never built when the bucket is too short for the block's lowest
  wanted score, ``score <= |anchor| * |row|``;
* inside, an anchor that wants ``need`` or more asks for cosines of
  ``t = need / (|anchor| * longest)`` or more; each of its ``FOCUS`` largest
  coordinates then has a feasible range, found by binary search in the sorted
  list; the rows in all ranges are the candidates, verified exactly. Where the
  narrowest range still holds over ``DENSE`` of the bucket, all of it is
  verified by one product.

Buckets are searched in rounds that grow ``GROWTH`` times, longest rows first.
After a round the k-th best score of a search becomes its new lowest wanted
score, so later rounds emit and verify less. Anchors are a stated query set
(one row in fifty) against all rows in blocks: a cell holds a bounded block and
a bounded bucket, joined one to one, so no label or vector, however frequent,
meets in one task.

Defined results: rows with a null label or vector, or a null, NaN or infinite
component, take no part; components that a shorter vector lacks count as 0, an
empty vector is zero; equal scores go by smaller id, null ids last; repeated rows
are rows of their own (each may be the other's positive, and anchors repeat); a
positive with a negative score has no negatives; an empty table gives no rows;
columns that are not named are not read. Scores must fit 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.common import batch_of, bounded_batches, materialize, shuffle_partitions
from wardlens.plans.ordering import global_positions

BUCKET = 4096
ANCHORS = 1024
FOCUS = 3
DENSE = 0.25
GROWTH = 8
LEAST, MOST = -(1 << 62), 1 << 62
_SLACK = 1e-9
_EXACT = 1 << 53


def integer_rows(rows: DataFrame, *, id_col: str, label: Column, vector_col: str, anchor: Column, scale: int) -> DataFrame:
    """Rows that take part: uid, id, label, anchor, v (``floor(scale * component)``) and norm."""
    good = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return (rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.when(good, whole).alias("v"))
            .where("label is not null and v is not null")
            .select("id", "label", "anchor", "v", F.sqrt(square).alias("norm"), F.monotonically_increasing_id().alias("uid")))


def _ints(array: pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    flat = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


def _unit(m: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Rows at length one; zero rows stay zero."""
    return m / np.where(norm > 0, norm, 1.0)[:, None]


def _buckets(placed: DataFrame, kind: str) -> DataFrame:
    """One row per bucket: label, bucket, longest, and its ids, vectors and sorted coordinate lists as bytes."""
    schema = pa.schema([("label", pa.int64()), ("bucket", pa.int64()), ("longest", pa.float64()), ("ids", pa.binary()),
                        ("uids", pa.binary()), ("vectors", pa.binary()), ("norms", pa.binary()), ("lists", pa.binary())])

    def build(key, table):
        norm = table.column("norm").to_numpy()
        m = _ints(table.column("v"))
        lists = np.argsort(_unit(m, norm), axis=0, kind="stable").T.astype("<u2")
        ids = table.column("id").fill_null(MOST).to_numpy()  # null ids come last
        return pa.table([[key[0].as_py()], [key[1].as_py()], [float(norm.max())], [ids.astype("<i8").tobytes()],
                         [table.column("uid").to_numpy().astype("<i8").tobytes()], [m.astype(kind).tobytes()],
                         [norm.astype("<f8").tobytes()], [np.ascontiguousarray(lists).tobytes()]], schema=schema)

    keyed = placed.select("label", F.expr(f"pos div {BUCKET}").alias("bucket"), "id", "uid", "v", "norm")
    return keyed.groupBy("label", "bucket").applyInArrow(
        build, "label long, bucket long, longest double, ids binary, uids binary, vectors binary, norms binary, lists binary")


def _blocks(queries: DataFrame, kind: str) -> DataFrame:
    """One row per anchor block: label, block, reach (the least length that can matter) and the searches as bytes."""
    schema = pa.schema([("label", pa.int64()), ("block", pa.int64()), ("reach", pa.float64()), ("quids", pa.binary()),
                        ("slots", pa.binary()), ("lows", pa.binary()), ("highs", pa.binary()), ("anchors", pa.binary())])

    def build(key, table):
        col = {c: table.column(c).to_numpy().astype("<i8") for c in ("uid", "slot", "low", "high")}
        low, norm = col["low"].astype(float), table.column("norm").to_numpy()
        with np.errstate(divide="ignore"):
            reach = np.where(low <= 0, -np.inf, np.where(norm > 0, low / np.where(norm > 0, norm, 1), np.inf))
        return pa.table([[key[0].as_py()], [key[1].as_py()], [float(reach.min())], [col["uid"].tobytes()],
                         [col["slot"].tobytes()], [col["low"].tobytes()], [col["high"].tobytes()],
                         [_ints(table.column("v")).astype(kind).tobytes()]], schema=schema)

    return queries.select("label", "block", "uid", "slot", "low", "high", "v", "norm").groupBy("label", "block").applyInArrow(
        build, "label long, block long, reach double, quids binary, slots binary, lows binary, highs binary, anchors binary")


def feasible(q: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of one unit coordinate, given the anchor's ``q`` there and a cosine of ``t`` or more."""
    half = np.sqrt(np.maximum(0.0, (1 - t * t) * (1 - q * q)))
    return np.where(-q >= t, -1.0, q * t - half) - _SLACK, np.where(q >= t, 1.0, q * t + half) + _SLACK


def candidates(unit: np.ndarray, lists: np.ndarray, anchors: np.ndarray, t: np.ndarray) -> list[np.ndarray | None]:
    """Rows of a bucket that may have cosine ``t`` or more with each (unit) anchor; None: all of them."""
    n, dims = unit.shape
    focus = np.argsort(-np.abs(anchors), axis=1, kind="stable")[:, :min(FOCUS, dims)]
    low, high = feasible(np.take_along_axis(anchors, focus, 1), t[:, None])
    first, last = np.zeros(focus.shape, np.int64), np.full(focus.shape, n)
    for f in np.unique(focus):
        at = focus == f
        values = unit[lists[f], f]
        first[at] = np.searchsorted(values, low[at], "left")
        last[at] = np.searchsorted(values, high[at], "right")
    out: list[np.ndarray | None] = []
    for i in range(len(anchors)):
        width = last[i] - first[i]
        j = int(np.argmin(width)) if dims else 0
        if not dims or t[i] <= 0 or width[j] > DENSE * n:
            out.append(None)
            continue
        rows = lists[focus[i, j], first[i, j]:max(first[i, j], last[i, j])].astype(np.int64)
        for x in range(focus.shape[1]):
            if x != j:
                v = unit[rows, focus[i, x]]
                rows = rows[(v >= low[i, x]) & (v <= high[i, x])]
        out.append(rows)
    return out


def _best(score: np.ndarray, rows: np.ndarray, ids: np.ndarray, uids: np.ndarray, k: int) -> np.ndarray:
    """Positions in ``rows`` of the ``k`` best scores; equal ones by id, then uid."""
    if len(rows) > k:
        keep = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        keep = np.arange(len(rows))
    return keep[np.lexsort((uids[rows[keep]], ids[rows[keep]], -score[keep]))[:k]]


def search_cell(block: dict, bucket: dict, kind: str, exact_float: bool, k: int) -> Iterator[tuple]:
    """(quid, slot, id, uid, score) of the ``k`` best rows of a bucket for each search of a block."""
    ids, uids = (np.frombuffer(bucket[c], "<i8") for c in ("ids", "uids"))
    quid, slot, low, high = (np.frombuffer(block[c], "<i8") for c in ("quids", "slots", "lows", "highs"))
    m = np.frombuffer(bucket["vectors"], kind).reshape(len(ids), -1)
    q = np.frombuffer(block["anchors"], kind).reshape(len(quid), -1)
    number = np.float64 if exact_float else np.int64
    m = m.astype(number)

    order = np.argsort(quid, kind="stable")
    own, start = np.unique(quid[order], return_index=True)
    of = np.split(order, start[1:])  # the searches of each anchor
    q = q[[x[0] for x in of]].astype(number)
    need = np.array([low[x].min() for x in of])
    length = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    bound = length * bucket["longest"]
    live = np.flatnonzero(need <= bound * (1 + _SLACK))
    if not len(live):
        return
    norms = np.frombuffer(bucket["norms"], "<f8")
    lists = np.frombuffer(bucket["lists"], "<u2").reshape(m.shape[1], len(ids))
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where((need[live] > 0) & (bound[live] > 0), np.minimum(need[live] / bound[live], 1.0), 0.0)
    some = candidates(_unit(m, norms), lists, _unit(q[live], length[live]), t)
    whole = [a for a, rows in zip(live, some, strict=True) if rows is None]
    dense = dict(zip(whole, q[whole] @ m.T, strict=True)) if whole else {}
    everyone = np.arange(len(ids))
    for a, rows in zip(live, some, strict=True):
        score = dense[a] if rows is None else m[rows] @ q[a]
        rows = everyone if rows is None else rows
        for s in of[a]:
            hit = np.flatnonzero((score >= low[s]) & (score <= high[s]) & (uids[rows] != own[a]))
            for x in hit[_best(score[hit], rows[hit], ids, uids, k)]:
                yield own[a], slot[s], ids[rows[x]], uids[rows[x]], score[x]


def _search(queries: DataFrame, buckets: DataFrame, kind: str, exact_float: bool, *, k: int, same_label: bool) -> DataFrame:
    """The ``k`` best rows for each search (uid, slot) of ``queries``: uid, slot, id, with, score, rank.

    ``queries`` has one row per search: label, block, uid, v, norm, slot and the
    scores wanted, ``low`` to ``high``.
    """
    spark = queries.sparkSession
    lanes = shuffle_partitions(spark)
    known = buckets.select("label", "bucket", "longest").withColumn(
        "round", F.row_number().over(Window.partitionBy("label").orderBy("bucket")) - 1)
    known = materialize(known.select(F.col("label").alias("b_label"), "bucket", "longest", "round",
                                     F.pmod("bucket", F.lit(lanes)).alias("lane")), "bucket-lengths")
    rounds = known.agg(F.max("round")).first()[0]
    schema = pa.schema([("uid", pa.int64()), ("slot", pa.int64()), ("id", pa.int64()), ("with", pa.int64()), ("score", pa.int64())])

    def cell_rows(batches):
        for b in batches:
            for row in b.to_pylist():
                got = list(zip(*search_cell(row, row, kind, exact_float, k)))
                if got:
                    yield batch_of(schema, {c: np.asarray(x).astype(np.int64) for c, x in zip(schema.names, got, strict=True)})

    best = spark.createDataFrame([], "uid long, slot long, id long, with long, score long, rank int")
    if rounds is None:
        return best
    top = Window.partitionBy("uid", "slot").orderBy(F.desc("score"), "id", "with")
    first, width = 0, 1
    while first <= rounds:
        blocks = materialize(_blocks(queries, kind), "anchor-blocks")
        pair = (F.col("label") == F.col("b_label")) if same_label else (F.col("label") != F.col("b_label"))
        cells = (blocks.select("label", "block", "reach", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
                 .join(known.where(F.col("round").between(first, first + width - 1)), "lane")
                 .where(pair & (F.col("longest") * (1 + _SLACK) >= F.col("reach")))
                 .select("label", "block", "b_label", "bucket"))
        own = buckets.withColumnRenamed("label", "b_label")
        found = (cells.join(blocks.drop("reach"), ["label", "block"]).join(own, ["b_label", "bucket"])
                 .mapInArrow(cell_rows, "uid long, slot long, id long, with long, score long"))
        best = materialize(best.drop("rank").unionByName(found).withColumn("rank", F.row_number().over(top))
                           .where(F.col("rank") <= k), "best")
        first, width = first + width, width * GROWTH
        if first <= rounds:
            reached = best.where(F.col("rank") == k).select("uid", "slot", F.col("score").alias("reached"))
            queries = materialize(queries.join(reached, ["uid", "slot"], "left")
                                  .withColumn("low", F.greatest("low", F.coalesce("reached", "low"))).drop("reached"), "searches")
    return best


def hard_negatives(rows: DataFrame, *, id_col: str, label: Column, vector_col: str, anchor: Column, positives: int = 5,
                   negatives: int = 3, low_percent: int = 50, high_percent: int = 95, scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each row where ``anchor`` holds and each of its ``positives`` best other
    rows of the same label: the ``negatives`` best rows of another label with
    ``low_percent * positive <= 100 * score <= high_percent * positive``.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    ready = materialize(integer_rows(rows, id_col=id_col, label=label, vector_col=vector_col, anchor=anchor, scale=scale), "vectors")
    dims, longest, largest = ready.agg(F.max(F.size("v")), F.max("norm"),
                                       F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()
    dims, exact_float = dims or 0, (longest or 0.0) ** 2 < _EXACT
    kind = "<i4" if (largest or 0) < 1 << 31 else "<i8"
    padded = ready.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v"))))
    placed = global_positions(padded, ["label", "-norm", "uid"], "pos")
    buckets = materialize(_buckets(placed, kind), "buckets")

    chosen = global_positions(padded.where("anchor").drop("anchor"), ["label", "uid"], "pos")
    chosen = materialize(chosen.withColumn("block", F.expr(f"pos div {ANCHORS}")).drop("pos"), "anchors")
    wide = chosen.withColumns({"slot": F.lit(0).cast("long"), "low": F.lit(LEAST).cast("long"), "high": F.lit(MOST).cast("long")})
    near = _search(wide, buckets, kind, exact_float, k=positives, same_label=True)
    near = near.select("uid", F.col("rank").cast("long").alias("slot"), F.col("id").alias("positive"), F.col("score").alias("reward"))

    asked = chosen.join(near.where("reward >= 0"), "uid").withColumns({
        "low": F.expr(f"(reward * {low_percent} + 99) div 100"), "high": F.expr(f"(reward * {high_percent}) div 100")})
    asked = materialize(asked.drop("positive", "reward"), "searches")
    far = _search(asked, buckets, kind, exact_float, k=negatives, same_label=False)
    named = lambda c: F.when(F.col(c) != MOST, F.col(c))
    return (far.join(near, ["uid", "slot"]).join(chosen.select("uid", F.col("id").alias("anchor_id")), "uid")
            .select("anchor_id", named("positive").alias("positive_id"), "rank", named("id").alias("negative_id"),
                    F.col("reward").alias("positive_score"), F.col("score").alias("negative_score")))
