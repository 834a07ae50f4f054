"""Operator 13 against the library itself."""

import random

import pytest
from tokenizers import Tokenizer

from llm_fixtures import SF_SMALL, documents, vocabulary  # noqa: F401
from wardlens.llm import token_counts as tc

TEXTS = ["", " ", "\n\n word", "hello  world \n\n\n x", "it's we'LL 'sa ''s", "<|endoftext|> a<|endoftext|>b <|endoftext",
         "naïve façade Ünïcode İ? 日本語 текст 123²³ ½", "࢏ odd ꟒ letters", "a\u0085b\u001cc　d e",
         "x" * 5000, "tab\t\ttab \r\n", "emoji 👩‍👩‍👧 fin", "\x00null\x00"]


@pytest.fixture()
def args(vocabulary):
    import public_tokenizers

    return vocabulary("byte_bpe_50k.json"), public_tokenizers.PATTERN


def library(path, texts):
    t = Tokenizer.from_file(path)
    return [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_counts_equal_the_library_for_any_cache_and_piece_size(args, monkeypatch):
    rng = random.Random(5)
    marks = ["a", "Zé", " ", "  ", "\n", "'s", "'", "42", "…", "ß", "՘", "<|endoftext|>", "ﬁ", ".", "\t"]
    texts = TEXTS + ["".join(rng.choices(marks, k=rng.randint(1, 40))) for _ in range(3000)]
    expected = library(args[0], texts)
    assert tc.LengthTable(*args).count(texts) == expected
    monkeypatch.setattr(tc, "PIECE_CHARS", 7)
    monkeypatch.setattr(tc, "pieces", lambda t, f=tc.pieces: f(t, 7))
    monkeypatch.setattr(tc, "MAX_CACHED", 3)
    assert tc.LengthTable(*args, {"a": 1}).count(texts) == expected


def test_pieces_cut_before_white_space_and_join_to_the_text():
    text = "one two  three\n\nfour " * 50
    parts = list(tc.pieces(text, 16))
    assert "".join(parts) == text and len(parts) > 10
    assert all(p[0].isspace() and not q[-1].isspace() for q, p in zip(parts, parts[1:]))


def test_operator_with_nulls_repeats_and_clashing_columns(spark, documents, args):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(99, None, None), (None, "a b", "de"), (3, "again", "en"), (3, "again", "en")]
    for head in (tc.HEAD, 0):
        got = tc.token_counts(documents(rows), *args, limit=4, head=head)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        texts = [t or "" for _, t, _ in rows]
        expected = [(d, len(t.encode()), n, n > 4) for (d, _, _), t, n in zip(rows, texts, library(args[0], texts))]
        key = lambda r: tuple((x is None, x) for x in r)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)
    assert tc.token_counts(documents([]), *args).count() == 0


def test_head_is_bounded_and_holds_the_most_frequent(spark, documents, args):
    docs = documents([(i, " the cat" * 20 + f" w{i}", "en") for i in range(50)])
    head = tc.frequent_lengths(docs, *args, head=2)
    assert head == {" the": 1, " cat": 1}


def test_query_equals_the_library_on_given_tables(spark, args):
    import __spark_entry__ as entry

    got = {r["doc_id"]: r for r in entry.queries()["op13_token_counts"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d, n in zip(docs, library(args[0], [d["text"] or "" for d in docs])):
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["over_limit"], r["n_bytes"]) == (n, n > 512, len((d["text"] or "").encode()))
