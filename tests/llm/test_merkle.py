"""Operator 12 against a plain recursive Merkle tree."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm_fixtures import documents  # noqa: F401
from wardlens.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    d, t, lang, source, n = row
    return H(*[framed(x) for x in (d, source, lang, n, text)])


def tree(hashes, f):
    """Root of ``hashes`` and each one's path of (left, right)."""
    paths, place, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        for i, p in enumerate(place):
            run = p // f * f
            paths[i].append(("".join(level[run:p]), "".join(level[p + 1:run + f])))
        level = [H(*level[r:r + f]) for r in range(0, len(level), f)]
        place = [p // f for p in place]
    return level[0], paths


def brute(rows, f, tampered):
    groups = defaultdict(list)
    for d, t, lang, source, n in rows:
        groups[lang].append((d, leaf((d, t, lang, source, n), t), t, source, n))
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    made = {}
    for k in names:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        made[k] = tree([r[1] for r in groups[k]], f)
    root, upper = tree([made[k][0] for k in names], f)
    out = []
    for k, up in zip(names, upper):
        for (d, h, t, source, n), path in zip(groups[k], made[k][1]):
            path = path + up
            changed = d is not None and zlib.crc32(str(d).encode()) % 3 == 0
            low = None if t is None else t.translate({c: c + 32 for c in range(65, 91)})
            at = leaf((d, t, k, source, n), low) if changed and tampered else h
            for left, right in path:
                at = H(left, at, right)
            out.append((d, h, made[k][0], root, H("".join(a + b for a, b in path)), at, at == root))
    return sorted(out, key=str)


def run(docs, f):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    made = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], id_col="doc_id", group_col="lang",
                           fanout=f, altered={"text": F.translate("text", upper, upper.lower())},
                           when=F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    path = F.col("path")
    made = made.select("id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(path), 256).alias("proof"),
                       merkle.folded(F.coalesce("altered_leaf", "leaf"), path).alias("folded"))
    return sorted([(*r, r["folded"] == r["root"]) for r in made.collect()], key=str)


def sample(n, langs, seed):
    rng = random.Random(seed)
    texts = ["", None, "Ünï Text", "plain", "UPPER Lower", "x" * 3000, "日本"]
    return [(i if rng.random() > .05 else None, rng.choice(texts), rng.choice(langs)) for i in range(n)]


@pytest.mark.parametrize("f, n, langs", [(8, 150, ["en", "de", None]), (2, 21, ["a", "b", "B", "ä", "zz"]), (3, 40, ["one"]),
                                         (8, 30, [f"l{i}" for i in range(20)])])
def test_equals_a_plain_tree(spark, documents, f, n, langs):  # noqa: F811
    rows = sample(n, langs, n)
    rows += rows[:7] + [(rows[0][0], "other text of the same id", rows[0][2])]
    full = [(d, t, k, None, None if t is None else len(t)) for d, t, k in rows]
    assert run(documents(rows), f) == brute(full, f, True)


def test_one_leaf_is_its_own_root_and_no_rows_give_none(spark, documents):  # noqa: F811
    [(d, h, sub, root, proof, fold, ok)] = run(documents([(5, "a", "en")]), 8)
    assert h == sub == root == fold and ok and proof == H("")
    assert run(documents([]), 8) == []
    with pytest.raises(ValueError):
        run(documents([]), 1)


def test_a_changed_leaf_no_longer_folds_to_the_root(spark, documents):  # noqa: F811
    rows = [(i, "Some TEXT" if i % 2 else "small", "en") for i in range(60)]
    for d, _, _, _, _, _, ok in run(documents(rows), 8):
        changed = zlib.crc32(str(d).encode()) % 3 == 0 and d % 2 == 1
        assert ok is not changed


def test_group_with_most_rows_is_placed_without_gaps(spark):
    leaves = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("hot").alias("key"),
        (F.col("id") % 50).alias("id"), F.lit("same").alias("hash"), F.monotonically_increasing_id().alias("uid"))
    placed = merkle._placed(leaves).groupBy("key").agg(
        F.count("*").alias("c"), F.count_distinct("idx").alias("d"), F.max("idx").alias("m"), F.min("n").alias("n"))
    assert placed.where("c != d or m != c - 1 or n != c").count() == 0 and placed.where("key = 'hot'").first()["c"] == 3333
