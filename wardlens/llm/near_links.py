"""Links between near-equal sets: banding candidates, exact verification, components.

A bucket (a band key) may hold a very large group, so its pairs are never
listed. Instead

1. every member of a bucket is compared with the bucket's leader, the member
   that shares most buckets with others (in a group of near copies that is the
   least altered one). Verified links are joined to components;
2. buckets whose members lie in one component are finished. The members of the
   others are dealt anew, over the rare items that every partner must share
   (prefix filter: with the items in order of rarity, two sets that reach the
   threshold have their first common item in the prefix of both). A member
   whose rare items nobody else has is finished too;
3. these buckets are finished in rounds of 8, 32, 128, ... random leaders each,
   compared with the members of other components that come later in the
   bucket's random order and whose sizes and positions still allow the
   threshold. After the last round every such pair has been compared, or its
   ends were found in one component, so no link found by the bands is lost.

Sets are 32-bit hashes; similarity is the Jaccard similarity of the distinct
hashes or, where items repeat, the probability Jaccard similarity of the
counts if that is larger.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.common import batch_of, materialize
from wardlens.llm.components import connected_components

MEMBERS_PER_SALT = 500
FIRST_LEADERS, MORE_LEADERS = 8, 4
# Bounds are compared in floating point; this much beyond them still counts.
SLACK = 1e-6


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Exact probability Jaccard of two weighted sets (sorted distinct items)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    items = np.union1d(a, b)
    x, y = np.zeros(len(items)), np.zeros(len(items))
    x[np.searchsorted(items, a)], y[np.searchsorted(items, b)] = wa / wa.sum(), wb / wb.sum()
    both = np.nonzero((x > 0) & (y > 0))[0]
    # Sum over common i of 1 / sum_j max(x_j / x_i, y_j / y_i): with items by ratio x/y, prefix sums give it.
    with np.errstate(divide="ignore"):
        ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    sx = np.concatenate([[0], np.cumsum(x[order])])
    sy = np.concatenate([[0], np.cumsum(y[order])])
    cut = np.searchsorted(ratio[order], ratio[both], side="right")
    total = (sx[-1] - sx[cut]) / x[both] + sy[cut] / y[both]
    return float((1 / total).sum())


def similarity(a: np.ndarray, wa: np.ndarray | None, b: np.ndarray, wb: np.ndarray | None) -> float:
    if not len(a) or not len(b):
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    jaccard = common / (len(a) + len(b) - common)
    if wa is None and wb is None or not common:
        return jaccard
    one = lambda items, w: np.ones(len(items)) if w is None else w.astype(float)
    return max(jaccard, probability_jaccard(a, one(a, wa), b, one(b, wb)))


def verified_links(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (lead, uid) whose sets reach ``threshold``, as (a, b).

    A lead's members are dealt over salts, its set is sent to each salt once,
    and the members stream past it.
    """
    pairs = materialize(pairs.select("lead", "uid").distinct(), "near-pairs")
    if pairs.isEmpty():
        return pairs.select(F.col("lead").alias("a"), F.col("uid").alias("b"))
    n = pairs.groupBy("lead").agg(F.count("*").alias("n")).withColumn("salts", F.ceil(F.col("n") / MEMBERS_PER_SALT).cast("int"))
    members = (pairs.join(n.select("lead", "salts"), "lead")
               .select("lead", F.pmod(F.xxhash64("uid"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("kind"), "uid"))
    leads = n.select("lead", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"),
                     F.col("lead").alias("uid"))
    # The sets are the large side at every size: a sort-merge join, so the plan (and its cost) follows the input.
    rows = members.unionByName(leads).join(sets.select("uid", "items", "reps").hint("merge"), "uid")
    rows = rows.select("lead", "salt", "kind", "uid", "items", "reps").repartition("lead", "salt").sortWithinPartitions("lead", "salt", "kind")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches):
        lead, own = None, (None, None)
        for batch in batches:
            out_a, out_b = [], []
            for d, _, kind, uid, items, reps in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                these = np.frombuffer(items, "<u4"), np.frombuffer(reps, "<u4") if reps else None
                if kind == 0:
                    lead, own = d, these
                elif d == lead and similarity(*own, *these) >= threshold:
                    out_a.append(d)
                    out_b.append(uid)
            if out_a:
                yield batch_of(schema, {"a": out_a, "b": out_b})

    return materialize(rows.mapInArrow(compare, "a long, b long"), "near-links")


def _prefixes(sets: DataFrame, lost: float) -> DataFrame:
    """(key, uid, size, mass, before, mass_before, repeats): the rare items that any partner of a set must share.

    Items are ordered by the number of sets that hold them. Of two sets that
    reach the threshold, all items before their first common one are lost to
    the pair, so these are at most a share ``lost`` of either set, by number
    or by mass; further items need no row. ``size`` counts distinct items and
    ``mass`` all of them; ``before`` and ``mass_before`` those ahead of the row's.
    """
    schema = pa.schema([("uid", pa.int64()), ("key", pa.int64()), ("weight", pa.int64())])

    def spread(batches):
        for batch in batches:
            for uid, items, reps in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = np.frombuffer(items, "<u4").astype(np.int64)
                w = np.frombuffer(reps, "<u4").astype(np.int64) if reps else np.ones(len(x), np.int64)
                for at in range(0, len(x), 65536):
                    part = slice(at, at + 65536)
                    yield batch_of(schema, {"uid": np.full(len(x[part]), uid, np.int64), "key": x[part], "weight": w[part]})

    rows = sets.select("uid", "items", "reps").mapInArrow(spread, "uid long, key long, weight long")
    held = rows.groupBy("key").agg(F.count("*").alias("holders"))
    whole = Window.partitionBy("uid")
    ahead = whole.orderBy("holders", "key").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    ranked = rows.join(held.hint("merge"), "key").select(
        "key", "uid", "holders", F.count("*").over(ahead).alias("before"), F.coalesce(F.sum("weight").over(ahead), none).alias("mass_before"),
        F.count("*").over(whole).alias("size"), F.sum("weight").over(whole).alias("mass"))
    return ranked.where((F.col("holders") > 1) & ((F.col("before") <= lost * F.col("size") + SLACK)
                                                  | (F.col("mass_before") <= lost * F.col("mass") + SLACK))).select(
        "key", "uid", "size", "mass", "before", "mass_before", (F.col("mass") > F.col("size")).alias("repeats"))


def _between(links: DataFrame, roots: DataFrame) -> DataFrame:
    """``links`` with their ends replaced by the names of their components."""
    at = lambda end, name: roots.select(F.col("node").alias(end), F.col("root").alias(name))
    return links.join(at("a", "ra"), "a", "left").join(at("b", "rb"), "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))


def near_components(keyed: DataFrame, sets: DataFrame, threshold: float, lost: float | None = None) -> DataFrame:
    """(node, root) of the components of verified links among items that share a band key.

    ``keyed`` has (uid, keys) and ``sets`` (uid, items, reps), one row per uid.
    Items without any link have no row. ``lost`` is the largest share of a set
    that a link may leave uncommon: 1 - threshold, less where sets that share
    a key are of one size.
    """
    bands = keyed.select("uid", F.explode("keys").alias("key"))
    count = materialize(bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "near-counts")
    multi = materialize(bands.join(count, "key").select("key", "uid", "n"), "near-buckets")
    score = multi.groupBy("uid").agg(F.sum("n").alias("score"))
    # Scores meet the items, not their keys, before the keys are dealt out.
    lead = (keyed.join(score, "uid").select("uid", "score", F.explode("keys").alias("key")).groupBy("key")
            .agg(F.max(F.struct("score", (-F.col("uid")).alias("first"))).alias("m"), F.count("*").alias("n"))
            .where("n > 1").select("key", (-F.col("m.first")).alias("lead")))
    links = verified_links(multi.join(lead, "key").where("uid != lead").select("lead", "uid"), sets, threshold)
    roots = connected_components(links)

    def open_buckets(rows: DataFrame) -> DataFrame:
        """``rows`` with (key, uid, ...) of buckets whose members lie in more than one component, their root and count n."""
        named = rows.drop("root", "n").join(roots.withColumnRenamed("node", "uid"), "uid", "left").withColumn(
            "root", F.coalesce("root", "uid"))
        mixed = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).where("lo != hi")
        return named.join(mixed.select("key", "n"), "key")

    active = materialize(open_buckets(multi), "near-open")
    if active.isEmpty():
        return roots
    own = materialize(sets.hint("merge").join(active.select("uid").distinct(), "uid", "left_semi"), "near-sets")
    active = materialize(open_buckets(materialize(_prefixes(own, 1 - threshold if lost is None else lost), "near-prefixes")), "near-open")
    shift, step = 0, FIRST_LEADERS
    while not active.isEmpty():
        place = (F.pmod(F.xxhash64("uid", "key"), F.lit(1 << 40)) / F.lit(float(1 << 40))) * F.col("n")
        rows = active.withColumn("place", place)
        leads = rows.where((F.col("place") >= shift) & (F.col("place") < shift + step))
        rename = {c: f"l_{c}" for c in ("uid", "root", "place", "size", "mass", "before", "mass_before", "repeats")}
        leads = leads.select("key", *[F.col(c).alias(n) for c, n in rename.items()])
        # Exact where the key is the pair's first common item, which is one of its keys.
        shared = F.least(F.col("size") - F.col("before"), F.col("l_size") - F.col("l_before"))
        # With shares a, b of the masses that may be common, probability Jaccard is at most ab / (a + b - ab).
        a, b = 1 - F.col("mass_before") / F.col("mass"), 1 - F.col("l_mass_before") / F.col("l_mass")
        weighted = (F.col("repeats") | F.col("l_repeats")) & (a * b >= threshold * (a + b - a * b) - SLACK)
        possible = weighted | (shared >= threshold * (F.col("size") + F.col("l_size") - shared) - SLACK)
        later = (F.col("place") > F.col("l_place")) | ((F.col("place") == F.col("l_place")) & (F.col("uid") > F.col("l_uid")))
        pairs = rows.join(leads, "key").where((F.col("root") != F.col("l_root")) & possible & later).select(
            F.col("l_uid").alias("lead"), "uid")
        new = verified_links(pairs, own, threshold)
        if not new.isEmpty():
            # Links found later join whole components: work on their names.
            merged = connected_components(_between(new, roots)).select(F.col("node").alias("root"), F.col("root").alias("above"))
            alone = new.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(roots.select("node"), "node", "left_anti")
            known = roots.unionByName(alone.select("node", F.col("node").alias("root")))
            roots = materialize(known.join(merged, "root", "left").select("node", F.coalesce("above", "root").alias("root")), "near-roots")
        shift, step = shift + step, MORE_LEADERS * step
        # Leaders so far have met everyone after them; a bucket with fewer than two members beyond is finished.
        n = active.select("key", "n").distinct()
        left = active.withColumn("place", place).where(F.col("place") >= shift).drop("place")
        active = materialize(open_buckets(left).drop("n").join(n, "key"), "near-open")
    return roots
