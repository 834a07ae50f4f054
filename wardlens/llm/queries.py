"""Registered queries of the training-data operators, with production parameters.

Each query runs its operator over the whole table and derives the columns its
contract asks for. Operators that plain SQL can state have an oracle in
:data:`ORACLES`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BYTE_BPE, WORD_BPE, SCAN_BPE, PIECES = "byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as block files in doc_id order and read back."""
    from wardlens.llm.token_blocks import token_blocks_round_trip

    back = token_blocks_round_trip(_table(spark, sf_dir, "documents"), _vocabulary(BYTE_BPE), end_id=2)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    from wardlens.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), _vocabulary(WORD_BPE), capacity=2048, end_id=0)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written to archives and read back."""
    from wardlens.llm.warc import warc_round_trip

    return warc_round_trip(_table(spark, sf_dir, "pages"), min_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    import public_tokenizers

    from wardlens.llm.secrets import scan_secrets, span_digest

    return span_digest(scan_secrets(_table(spark, sf_dir, "documents"), _vocabulary(SCAN_BPE), public_tokenizers.PATTERN))


def op5_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs that repeat across documents, by cluster; all but the first of a cluster are removals."""
    from wardlens.llm.paragraphs import repeated_paragraphs

    return repeated_paragraphs(_table(spark, sf_dir, "documents"))


def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its recurring lines."""
    from wardlens.llm.line_templates import drop_recurring_lines

    return drop_recurring_lines(_table(spark, sf_dir, "documents"), chars_col="n_chars", counts=True)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    from wardlens.llm.decontamination import contamination

    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: F.coalesce(x.cast("string"), F.lit("")))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-model and lattice-model log probability of every document."""
    from wardlens.llm.lattice_lm import lattice_scores

    return lattice_scores(_table(spark, sf_dir, "documents"), _vocabulary(PIECES))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, distribution distances and verdict of every document."""
    from wardlens.llm.quality import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents"))


def op10_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    from wardlens.llm.minhash import duplicate_classes

    return duplicate_classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor (vec_id divisible by 50) and positive."""
    from wardlens.llm.hard_negatives import hard_negatives

    vec_id, label = F.col("vec_id"), F.col("label")
    return hard_negatives(_table(spark, sf_dir, "embeddings"), id_col="vec_id", vector_col="embedding",
                          label=F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label), anchor=vec_id % 50 == 0,
                          positives=5, negatives=3, low_percent=50, high_percent=95, scale=256)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether a possibly tampered leaf still folds to the root."""
    from wardlens.llm.merkle import folded, manifest, proof_text

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    made = manifest(_table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
                    id_col="doc_id", group_col="lang", fanout=8,
                    altered={"text": F.translate("text", upper, upper.lower())},
                    when=F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    return made.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        folded(F.coalesce("altered_leaf", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    import public_tokenizers

    from wardlens.llm.token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), _vocabulary(BYTE_BPE), public_tokenizers.PATTERN)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole corpus pipeline (corpus_pipeline.py)."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_token_blocks, op2_best_fit_packing, op3_warc, op4_secret_scan, op5_paragraph_dedup, op6_line_templates,
    op7_decontamination, op8_lattice_lm, op9_quality_rules, op10_probminhash, op11_hard_negatives, op12_merkle_manifest, op13_token_counts, pipeline)}

_SHA1_BASE32 = """array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(sha1(body) || '0', CAST((5 * i) // 4 + 1 AS INTEGER), 2) AS INTEGER)
                 >> CAST(3 - (5 * i) % 4 AS INTEGER)) & 31), 1)), '')"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_FRAMED = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"


def _merkle_levels(name: str, start: str, depth: int) -> str:
    """Levels ``name``0.. of an eightfold tree over ``start`` (k, i, n, h), and each node's siblings as ``name``_s0..."""
    out = [f"{name}0 AS (SELECT k, i, n, h FROM {start})"]
    for j in range(depth):
        at = f"{name}{j}"
        out += [f"""{name}_s{j} AS (SELECT a.k, a.i, a.n,
       coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
       coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM {at} a JOIN {at} b ON a.k = b.k AND a.i // 8 = b.i // 8 GROUP BY a.k, a.i, a.n)""",
                f"""{name}{j + 1} AS (SELECT k, i // 8 AS i, (n + 7) // 8 AS n,
       CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {at} GROUP BY k, i // 8, n)"""]
    return ",\n".join(out)


def _merkle_fold(name: str, start: str, depth: int, keep: str) -> str:
    """Climb from ``start`` (k, i, p, f, ...): append each level's siblings to p and fold f with them."""
    out, last = [], start
    for j in range(depth):
        out.append(f"""{name}_f{j} AS (SELECT {keep}, c.k, c.i // 8 AS i, c.p || s.l || s.r AS p,
       CASE WHEN s.n > 1 THEN sha256(s.l || c.f || s.r) ELSE c.f END AS f
  FROM {last} c JOIN {name}_s{j} s ON c.k = s.k AND c.i = s.i)""")
        last = f"{name}_f{j}"
    return ",\n".join(out)


_CRC32 = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))))"""

_LEAF = "sha256(" + " || ".join(_FRAMED.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op11_hard_negatives": """
WITH r AS (SELECT row_number() OVER () AS u, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.u AS a, a.vec_id AS anchor_id, a.label = b.label AS same, b.u, b.vec_id,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.u <> b.u WHERE a.vec_id % 50 = 0),
p AS (SELECT a, anchor_id, u, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, u) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.a, p.u ORDER BY s.score DESC, s.vec_id NULLS LAST, s.u) AS k
      FROM p JOIN s ON p.a = s.a AND NOT s.same
       AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 3""",
    # Eight levels hold 16 million documents of one language, three 512 languages.
    "op12_merkle_manifest": f"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, coalesce('=' || lang, '') AS k, {_LEAF.format(text="text")} AS h,
                  CASE WHEN {_CRC32} % 3 = 0 THEN {_LEAF.format(text=_LOWERED)} END AS t FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h, u) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM d),
{_merkle_levels("t", "o", 8)},
{_merkle_fold("t", "(SELECT *, '' AS p, coalesce(t, h) AS f FROM o)", 8, "c.u, c.doc_id, c.h")},
g AS (SELECT '' AS k, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n, h, k AS name FROM t8),
{_merkle_levels("g", "g", 3)},
{_merkle_fold("g", "(SELECT q.u, q.doc_id, q.h, q.p, q.f, g.h AS subroot, g.k, g.i FROM t_f7 q JOIN g ON g.name = q.k)", 3,
              "c.u, c.doc_id, c.h, c.subroot")}
SELECT doc_id, c.h AS leaf, subroot, g3.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = g3.h AS verified
FROM g_f2 c JOIN g3 ON c.k = g3.k""",
    "op3_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, {_SHA1_BASE32} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM g""",
    "op7_decontamination": f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k,
              array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT r, k, s, array_to_string(list_slice(w, s, s + k - 1), ' ') AS win
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s
             FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
m AS (SELECT dw.r, dw.k, dw.s, iw.item_id FROM dw JOIN iw USING (k, win)),
h AS (SELECT r, count(DISTINCT p) AS n_hit
      FROM (SELECT r, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT r, k, s FROM m)) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN n USING (r)""",
}
