"""Best-fit packing of token pieces into sequences (operator 2), bulk-synchronously.

State between rounds is two tables: unplaced pieces and open gaps (one row per
sequence that still has room). A round

1. range-sorts pieces and gaps together by size, largest first, gaps before
   pieces of the same size. A gap that could take several of the longest
   unplaced pieces offers that many slots;
2. sweeps each range: a piece takes the last slot seen, which is the smallest
   one that holds it (its successor). That is matching of brackets, done with
   running sums, so equal sizes and hot sizes need no special care;
3. matches what the ranges left over: the ranges' counts (one row per task)
   decide which ranks of pieces go to which ranks of slots, and a join on
   (range, rank) carries it out, so no two pieces claim one slot;
4. updates the gaps;
5. opens sequences for the longest pieces still unplaced: as many as their
   tokens need beyond the room left in gaps that could take one of them, and as
   the pieces longer than every gap need in any case;
6. drops the gaps below the shortest unplaced piece.

Rounds end when no piece is left. A round that would place less than
``LEAST_SHARE`` of the pieces opens more sequences, so the number of rounds
grows with the logarithm of the pieces at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.common import batch_of, bounded_batches, materialize, shuffle_partitions, text_or_empty
from wardlens.llm.encoding import share_frequent

PIECE = "piece int, start long, length long, ids binary"
# Rows of a range that one task sweeps in memory (about 50 bytes each): this many are worth a task of their own
# up to the session's shuffle partitions, and at most the second figure beyond.
ROWS_PER_RANGE, MOST_ROWS_PER_RANGE = 16_000, 500_000
LEAST_SHARE = 0.05


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int | None, *,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: the id column, piece, start, length, ids (little-endian u32 binary).

    A null text counts as empty. ``end_id`` closes every document. Only a
    document of more than ``capacity`` ids is cut; a document without any id
    (possible only when ``end_id`` is None) has no piece.
    """
    bounded_batches(docs.sparkSession)
    head = share_frequent(docs, tokenizer_path, text_col)
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    step = 4 * capacity
    schema = pa.schema([(id_col, pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids", pa.binary())])

    def cut(batches):
        from wardlens.llm.encoding import encoder

        enc = encoder(tokenizer_path, head)
        for batch in batches:
            rows = [(d, k // step, k // 4, len(raw[k:k + step]) // 4, raw[k:k + step])
                    for d, raw in zip(batch.column(0).to_pylist(),
                                      (x + end for x in enc.encode(batch.column(1))), strict=True)
                    for k in range(0, len(raw), step)]
            for at in range(0, len(rows), 1024):
                part = list(zip(*rows[at:at + 1024], strict=True))
                yield batch_of(schema, dict(zip(schema.names, map(list, part), strict=True)))

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(cut, f"{id_col} long, {PIECE}")


_SWEPT = pa.schema([("part", pa.int32()), ("is_slot", pa.bool_()), ("rank", pa.int64()), ("uid", pa.int64()),
                    ("size", pa.int64()), ("seq", pa.int64()), ("slot", pa.int32()), ("gap", pa.int64())])


def sweep(size: np.ndarray, is_slot: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Match pieces to slots in one range, largest first.

    Returns the row order of the sweep, for each piece in that order the row
    of its slot (or -1), and whether a row is left over.
    """
    order = np.lexsort((tie, ~is_slot, -size))
    slot = is_slot[order]
    step = np.where(slot, 1, -1)
    level = np.cumsum(step)
    # A piece that brings the sum to a new low below zero finds no slot.
    low = np.minimum.accumulate(np.minimum(level, 0))
    lonely = ~slot & (low < np.concatenate([[0], low[:-1]]))
    # Without the lonely pieces the brackets balance: at one depth, slots and pieces take turns.
    level = np.cumsum(np.where(lonely, 0, step))
    depth = np.where(slot, level, level + 1)
    match = np.full(len(order), -1, np.int64)
    rows = np.nonzero(~lonely)[0]
    seq = rows[np.lexsort((rows, depth[rows]))]
    pair = slot[seq[:-1]] & ~slot[seq[1:]] & (depth[seq[:-1]] == depth[seq[1:]])
    match[seq[1:][pair]] = order[seq[:-1][pair]]
    used = np.zeros(len(order), bool)
    used[match[match >= 0]] = True
    return order, match, np.where(slot, ~used[order], lonely)


def _sweep_ranges(merged: DataFrame, parts: int) -> DataFrame:
    def run(batches):
        table = pa.Table.from_batches(list(batches), schema=None) if batches else None
        if table is None or not table.num_rows:
            return
        part = TaskContext.get().partitionId()
        col = {n: table.column(n).to_numpy() for n in table.column_names}
        order, match, left = sweep(col["size"], col["is_slot"], col["tie"])
        slot = col["is_slot"][order]
        rank = np.zeros(len(order), np.int64)
        piece_left, slot_left = np.nonzero(left & ~slot)[0], np.nonzero(left & slot)[0]
        rank[piece_left] = np.arange(len(piece_left))
        rank[slot_left] = np.arange(len(slot_left))[::-1]  # from the last, smallest one
        keep = np.nonzero(~slot | left)[0]
        source = np.where(match >= 0, match, order)[keep]
        free = (left & ~slot)[keep]
        out = {"part": np.full(len(keep), part, np.int32), "is_slot": slot[keep],
               "rank": pa.array(rank[keep], mask=~left[keep]), "uid": col["uid"][order][keep],
               "size": col["size"][order][keep], "seq": pa.array(col["seq"][source], mask=free),
               "slot": pa.array(col["slot"][source].astype(np.int32), mask=free),
               "gap": pa.array(col["gap"][source], mask=free)}
        for at in range(0, len(keep), 65536):
            yield batch_of(_SWEPT, {k: (v if isinstance(v, pa.Array) else pa.array(v))[at:at + 65536]
                                    for k, v in out.items()})

    dealt = merged.repartitionByRange(parts, F.desc("size"), F.desc("is_slot"), "tie")
    return dealt.mapInArrow(run, "part int, is_slot boolean, rank long, uid long, size long, seq long, "
                                 "slot int, gap long")


def match_leftovers(parts: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int, int, int]], dict[int, int]]:
    """Which ranks of left-over pieces take which ranks of left-over slots.

    ``parts`` has (part, pieces left, slots left), largest sizes first.
    Returns (piece part, first piece rank, slot part, first slot rank, count)
    rows and, per part, how many of its pieces were matched.
    """
    stack: list[list[int]] = []
    rows, matched = [], {}
    for part, pieces, slots in parts:
        done = 0
        while done < pieces and stack:
            top = stack[-1]
            n = min(pieces - done, top[2])
            rows.append((part, done, top[0], top[1], n))
            done, top[1], top[2] = done + n, top[1] + n, top[2] - n
            if not top[2]:
                stack.pop()
        matched[part] = done
        if slots:
            stack.append([part, 0, slots])
    return rows, matched


def range_tasks(n_rows: int, partitions: int) -> int:
    """Ranges that ``n_rows`` pieces and gaps are swept in; the last rounds have few of either."""
    return max(1, min(partitions, -(-n_rows // ROWS_PER_RANGE)), n_rows // MOST_ROWS_PER_RANGE + 1)


def pack_best_fit(pieces: DataFrame, capacity: int, *, length_col: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces``, in as few sequences as best fit finds.

    Lengths must lie in 1..capacity (an error otherwise, also for null). The
    columns of ``pieces`` are carried through unchanged, but for columns of
    the two new names, which are replaced; ties in length go by an arbitrary
    but fixed row number. An empty input gives an empty result.
    """
    spark = pieces.sparkSession
    names = [f"c{i}" for i in range(len(pieces.columns))]  # clashing names cannot arise
    table = materialize(pieces.toDF(*names).withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    rest = table.select("uid", F.col(names[pieces.columns.index(length_col)]).cast("long").alias("size"))
    gaps = spark.createDataFrame([], "seq long, gap long")
    placed = []
    n, longest, shortest, wrong = rest.agg(
        F.count("*"), F.max("size"), F.min("size"),
        F.count_if(F.col("size").isNull() | ~F.col("size").between(1, capacity))).first()
    if wrong:
        raise ValueError(f"piece lengths must lie in 1..{capacity}")
    n_gaps = 0
    while n:
        parts = range_tasks(n + n_gaps, shuffle_partitions(spark))
        most = max(1, -(-2 * n // max(1, n_gaps)))  # slots of a gap, so that slots stay in proportion to pieces
        k = F.greatest(F.lit(1), F.least(F.floor(F.col("gap") / longest), F.lit(most))).cast("int")
        slots = (gaps.where(F.col("gap") >= shortest).withColumn("k", k)
                 .select("seq", "gap", "k", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("slot"))
                 .withColumn("size", F.when(F.col("slot") == 0, F.col("gap") - (F.col("k") - 1) * longest)
                             .otherwise(F.lit(longest))))
        merged = rest.select(F.lit(False).alias("is_slot"), "uid", "size", F.lit(-1).cast("long").alias("seq"),
                             F.lit(-1).alias("slot"), F.lit(0).cast("long").alias("gap"),
                             F.xxhash64("uid").alias("tie")).unionByName(
            slots.select(F.lit(True).alias("is_slot"), F.lit(-1).cast("long").alias("uid"), "size", "seq", "slot",
                         "gap", F.xxhash64("seq", "slot").alias("tie")))
        swept = materialize(_sweep_ranges(merged, parts), "pack-swept")
        # One row per range: what was left over there.
        left = swept.where("rank is not null").groupBy("part").agg(
            F.count_if(~F.col("is_slot")).alias("pieces"), F.count_if("is_slot").alias("slots")).orderBy("part").collect()
        links, matched = match_leftovers([tuple(r) for r in left])
        before, free = 0, []
        for r in left:
            free.append((r["part"], matched[r["part"]], before - matched[r["part"]]))
            before += r["pieces"] - matched[r["part"]]
        table_of = lambda rows, schema: F.broadcast(spark.createDataFrame(rows, schema))
        by_link = (swept.where("rank is not null and not is_slot").select("uid", "size", "part", "rank")
                   .join(table_of(links, "part int, from_rank long, slot_part int, slot_from long, n long"), "part")
                   .where("rank >= from_rank and rank < from_rank + n")
                   .select("uid", "size", "slot_part", (F.col("slot_from") + F.col("rank") - F.col("from_rank")).alias("slot_rank"))
                   .join(swept.where("is_slot").select(F.col("part").alias("slot_part"), F.col("rank").alias("slot_rank"),
                                                       "seq", "slot", "gap"), ["slot_part", "slot_rank"])
                   .select("uid", "size", "seq", "slot", "gap"))
        taken = swept.where("not is_slot and rank is null").select("uid", "size", "seq", "slot", "gap").unionByName(by_link)
        inside = Window.partitionBy("seq").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
        put = materialize(taken.select("uid", "seq", (
            capacity - F.col("gap") + F.sum("size").over(inside) - F.col("size")).alias("offset"), "size"), "pack-placed")
        placed.append(put)
        if not before:
            break
        used = put.groupBy("seq").agg(F.sum("size").alias("more"))
        gaps = materialize(gaps.join(used, "seq", "left").select(
            "seq", (F.col("gap") - F.coalesce("more", F.lit(0))).alias("gap")), "pack-gaps")
        # The unmatched, in order of size over all ranges: index = rank in its range + those of the ranges before.
        unmatched = (swept.where("rank is not null and not is_slot")
                     .join(table_of(free, "part int, done long, shift long"), "part")
                     .where("rank >= done").select("uid", "size", (F.col("rank") + F.col("shift")).alias("at")))
        shortest = unmatched.agg(F.min("size")).first()[0]
        room, widest = gaps.where(F.col("gap") >= shortest).agg(F.coalesce(F.sum("gap"), F.lit(0)),
                                                                F.coalesce(F.max("gap"), F.lit(0))).first()
        size = F.col("size")
        tokens, beyond, alone = unmatched.agg(
            F.sum("size"), F.coalesce(F.sum(F.when(size > widest, size)), F.lit(0)),
            F.count_if(size > max(capacity // 2, widest))).first()
        need = lambda t: -(-t // capacity)
        opened = max(need(max(0, tokens - room)), need(beyond), alone)
        if n - before + opened < LEAST_SHARE * n:
            opened = max(opened, need(tokens // 2), 1)
        opened = min(opened, before)
        new = materialize(unmatched.where(F.col("at") < opened).select(
            "uid", F.col("uid").alias("seq"), F.lit(0).cast("long").alias("offset"), "size"), "pack-placed")
        placed.append(new)
        rest = materialize(unmatched.where(F.col("at") >= opened).select("uid", "size"), "pack-rest")
        n, longest, shortest = rest.agg(F.count("*"), F.max("size"), F.min("size")).first()
        if n:
            gaps = gaps.unionByName(new.select("seq", (capacity - F.col("size")).alias("gap"))).where(F.col("gap") >= shortest)
            n_gaps = gaps.count()
    if not placed:
        at = spark.createDataFrame([], "uid long, seq long, offset long")
    else:
        at = placed[0].select("uid", "seq", "offset")
        for p in placed[1:]:
            at = at.unionByName(p.select("uid", "seq", "offset"))
    joined = table.join(at, "uid")
    return joined.select(*[F.col(c).alias(o) for c, o in zip(names, pieces.columns, strict=True)
                           if o.lower() not in ("sequence_id", "offset")],
                         F.col("seq").alias("sequence_id"), F.col("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int) -> DataFrame:
    """Tokenize, cut and pack; per piece its CRC-32 in place of the ids.

    The ids themselves come from :func:`tokenize_pieces`; packing needs only lengths, so
    only (doc_id, piece, start, length, ids_crc32) rows move through the rounds.
    """
    pieces = tokenize_pieces(docs, tokenizer_path, capacity, end_id)
    return pack_best_fit(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity)
