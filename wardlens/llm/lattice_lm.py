"""Corpus language model over all segmentations into subword pieces (operator 8).

The vocabulary and its scores come from an existing sentencepiece model; they
are not trained here. What is learnt from the training texts is how often each
piece is used: its share, smoothed towards the vocabulary's own scores. The
probability of a text is the product over its words of the sum over all
segmentations of the word into pieces, times that of the end of text. The sum
is taken by a forward recursion in log space over the word's characters; a
character the vocabulary lacks is spelled by byte pieces. A word's first
piece carries the vocabulary's word mark, so pieces never cross words and each
distinct word is worked out once.

Every distinct word of the corpus is counted with one shuffle. Words that make
up at least ``HEAD_SHARE`` of all words (at most 1 / HEAD_SHARE of them) go to
the tasks as a table; all other words of a document meet their counts in a
shuffled join.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import batch_of, bounded_batches, materialize

HEAD_SHARE = 1e-6
FLUSH = 400_000
PRIOR_TOKENS = 1000.0
MARK = "▁"
_MODELS: dict[str, object] = {}


def words_of(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased, cut at ASCII white space."""
    return text.lower().split() if text else []


def load_pieces(path: str):
    import sentencepiece

    if path not in _MODELS:
        _MODELS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _MODELS[path]


def prior_logs(model) -> np.ndarray:
    """Natural logs of the vocabulary's own piece shares; control and unknown pieces get none.

    Scores that already are log shares (they sum to about one) are taken as
    they are. Merge ranks (0, -1, -2, ...) are read as Zipf shares by rank.
    Byte pieces share one part in a thousand.
    """
    n = model.get_piece_size()
    special = np.array([model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)])
    byte = np.array([model.is_byte(i) for i in range(n)])
    score = np.array([model.get_score(i) for i in range(n)], np.float64)
    plain = ~special & ~byte
    share = np.zeros(n)
    total = np.exp(np.minimum(score[plain], 0)).sum() if plain.any() else 0
    if 0.5 <= total <= 1.5:
        share[plain] = np.exp(score[plain])
    else:
        rank = np.empty(int(plain.sum()))
        rank[np.argsort(-score[plain], kind="stable")] = np.arange(len(rank))
        share[plain] = 1.0 / (rank + 2.7)
    if plain.any():
        share[plain] *= (0.999 if byte.any() else 1.0) / share[plain].sum()
    if byte.any():
        share[byte] = (0.001 if plain.any() else 1.0) / byte.sum()
    with np.errstate(divide="ignore"):
        return np.log(share)


class Lattice:
    """Log probability of a word, summed over its segmentations."""

    def __init__(self, pieces: dict[str, float], byte_logs: list[float] | None):
        self.pieces, self.byte_logs = pieces, byte_logs
        self.longest = max(map(len, pieces), default=1)

    def word_log(self, word: str) -> float:
        """Natural log of the word's marginal probability (-inf when no segmentation spells it)."""
        text, pieces, longest = MARK + word, self.pieces, self.longest
        exp, log, inf = math.exp, math.log, -math.inf
        alpha = [0.0]
        for j in range(1, len(text) + 1):
            terms = []
            for i in range(max(0, j - longest), j):
                p = pieces.get(text[i:j])
                if p is not None and alpha[i] > inf:
                    terms.append(alpha[i] + p)
            if self.byte_logs is not None:
                terms.append(alpha[j - 1] + sum(self.byte_logs[b] for b in text[j - 1].encode("utf-8", "replace")))
            top = max(terms, default=inf)
            alpha.append(top + log(sum([exp(t - top) for t in terms])) if top > inf else inf)
        return alpha[-1]


def build_lattice(model, piece_logs: np.ndarray) -> Lattice:
    pieces, byte_logs = {}, {}
    for i in range(model.get_piece_size()):
        if not np.isfinite(piece_logs[i]):
            continue
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_logs[int(piece[1:-1], 16)] = float(piece_logs[i])
        elif MARK not in piece[1:]:
            pieces[piece] = float(piece_logs[i])
    return Lattice(pieces, [byte_logs[b] for b in range(256)] if len(byte_logs) == 256 else None)


def count_words(docs: DataFrame) -> DataFrame:
    """word (binary), c (uses in training texts), c_all (uses in all), for ``docs`` (held_out, text binary)."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("c_all", pa.int64())])

    def count(batches):
        train, every = Counter(), Counter()

        def flush():
            for at in range(0, len(keys := list(every)), 50_000):
                part = keys[at:at + 50_000]
                yield batch_of(schema, {"word": part, "c": [train[w] for w in part], "c_all": [every[w] for w in part]})
            train.clear()
            every.clear()

        for batch in batches:
            for held_out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                every.update(words)
                if not held_out:
                    train.update(words)
                if len(every) >= FLUSH:
                    yield from flush()
        yield from flush()

    return (docs.select("held_out", "text").mapInArrow(count, "word binary, c long, c_all long")
            .groupBy("word").agg(F.sum("c").alias("c"), F.sum("c_all").alias("c_all")))


def _piece_counts(words: DataFrame, model_path: str) -> np.ndarray:
    """Uses of each piece in the training words, by the existing tokenizer (one row per piece comes back)."""
    schema = pa.schema([("piece", pa.int32()), ("n", pa.float64())])

    def count(batches):
        model, total = load_pieces(model_path), None
        for batch in batches:
            total = np.zeros(model.get_piece_size()) if total is None else total
            texts = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            ids = model.encode(texts, num_threads=1)
            weight = np.repeat(np.array(batch.column(1).to_numpy(), np.float64), [len(x) for x in ids])
            flat = np.fromiter((i for x in ids for i in x), np.int64, len(weight))
            total += np.bincount(flat, weight, len(total))
        if total is not None:
            at = np.nonzero(total)[0]
            yield batch_of(schema, {"piece": at.astype(np.int32), "n": total[at]})

    out = np.zeros(load_pieces(model_path).get_piece_size())
    used = words.where("c > 0").select("word", "c").mapInArrow(count, "piece int, n double")
    for r in used.groupBy("piece").agg(F.sum("n").alias("n")).collect():
        out[r["piece"]] = r["n"]
    return out


def lattice_scores(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                   folds: int = 7, held_out_fold: int = 2) -> DataFrame:
    """Score every text by the word model (``base_score``) and the lattice model (``score``), both log10.

    Training texts are those whose crc32 of the id as text, modulo ``folds``,
    is not ``held_out_fold`` (a null id counts as the empty string). A null
    text counts as empty: it has the end token only. Other columns are ignored.
    Columns: id column, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
    rows = docs.select(F.col(id_col).cast("long").alias("id"), (fold == held_out_fold).alias("held_out"),
                       F.col(text_col).cast("string").cast("binary").alias("text"))
    counted = materialize(count_words(rows), "lm-counts")
    n_docs = rows.where(~F.col("held_out")).select("held_out").count()
    n_words, n_all, distinct = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("c_all"), F.lit(0)),
                                           F.count_if(F.col("c") > 0)).first()
    train_tokens, vocabulary = n_words + n_docs, distinct + (n_docs > 0)
    floor = math.log10(train_tokens + vocabulary + 1)

    # Piece shares: counts smoothed towards the vocabulary's own scores; the end of text is one more outcome.
    prior = prior_logs(load_pieces(model_path))
    used = _piece_counts(counted, model_path)
    used[~np.isfinite(prior)] = 0
    whole = used.sum() + n_docs + PRIOR_TOKENS + 1
    with np.errstate(divide="ignore"):
        piece_logs = np.log((used + PRIOR_TOKENS * np.exp(prior)) / whole)
    end_log = math.log10((n_docs + 1) / whole)
    model_b = spark.sparkContext.broadcast(piece_logs)
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("c_all", pa.int64()), ("lp", pa.float64())])

    def score_words(batches):
        lattice = build_lattice(load_pieces(model_path), model_b.value)
        for batch in batches:
            logs = [lattice.word_log(w.decode("utf-8", "replace")) / math.log(10) for w in batch.column(0).to_pylist()]
            yield batch_of(schema, {"word": batch.column(0), "c": batch.column(1), "c_all": batch.column(2), "lp": logs})

    words = materialize(counted.select("word", "c", "c_all").mapInArrow(
        score_words, "word binary, c long, c_all long, lp double"), "lm-words")
    head_at = max(1, math.ceil(n_all * HEAD_SHARE))
    # At most 1 / HEAD_SHARE words reach that share of all words.
    common = words.where(F.col("c_all") >= head_at).select("word", "c", "lp").toArrow().to_pydict()
    head = {w: (c, math.log10(c + 1), lp) for w, c, lp in zip(common["word"], common["c"], common["lp"], strict=True)}
    head_b = spark.sparkContext.broadcast(head)
    rest = pa.struct([("word", pa.binary()), ("tf", pa.int32())])
    row = pa.schema([("uid", pa.int64()), ("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("known", pa.int64()), ("base", pa.float64()), ("lp", pa.float64()), ("rest", pa.list_(rest))])

    def look_up(batches):
        table, part, at = head_b.value, TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            out = []
            for d, held_out, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words_here = words_of(text)
                known, base, lp, tail = 0, 0.0, 0.0, []
                for w, tf in Counter(words_here).items():
                    hit = table.get(w)
                    if hit is None:
                        tail.append({"word": w, "tf": tf})
                    else:
                        known, base, lp = known + tf * (hit[0] > 0), base + tf * hit[1], lp + tf * hit[2]
                out.append((part + at, d, held_out, len(words_here) + 1, known, base, lp, tail))
                at += 1
            cols = list(zip(*out, strict=True))
            if cols:
                yield batch_of(row, dict(zip(row.names, map(list, cols), strict=True)))

    seen = materialize(rows.mapInArrow(
        look_up, "uid long, id long, held_out boolean, n_tokens long, known long, base double, lp double, "
                 "rest array<struct<word:binary,tf:int>>"), "lm-docs")
    tail = (seen.select("uid", F.explode("rest").alias("r")).select("uid", "r.word", "r.tf")
            .join(words.where(F.col("c_all") < head_at).select("word", "c", F.col("lp").alias("w_lp")), "word")
            .groupBy("uid").agg(F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("t_base"),
                                F.sum(F.col("tf") * F.col("w_lp")).alias("t_lp"),
                                F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("t_known")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    end_base = math.log10(n_docs + 1)
    return seen.drop("rest").join(tail, "uid", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("known") + zero("t_known") + F.lit(int(n_docs > 0))).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("t_base") + F.lit(end_base) - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        (F.col("lp") + zero("t_lp") + F.lit(end_log)).alias("score"))
