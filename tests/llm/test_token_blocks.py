"""Encoder cache and token block files."""

import io
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import SF_SMALL, documents, vocabulary  # noqa: F401
from wardlens.llm import encoding, token_blocks
from wardlens.llm.encoding import Encoder

ODD = ["", " ", "a", "  a  b ", "x\n\n y\t z\r\n", "a\xa0 b", " \n x", "<|endoftext|> a", "a <|startoftext|>b", "don't  STOP",
       "é à́ ô", "½ ﬁ İ ς", "w" * 5000, "日本語 テキスト", "\x00 \x1f a", "a​b c", "ends in space ", "\n", "tab\there",
       "word, Word. WORD! word?! word.\" (word), été. x'. don't. it's, e\u0301. 3.14, a_. 日本。 5, ²! ...  ,, x;;y"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_encoding_equals_the_library(vocabulary, name):
    enc = Encoder(vocabulary(name))
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(ODD + list(" .,'\n")) for _ in range(30)) for _ in range(60)]
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == want
    assert enc.encode(texts) == want  # now from the cache


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_every_letter_before_stops_equals_the_library(vocabulary, name):
    from tokenizers import Tokenizer

    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha() and not 0x4E10 < c < 0x9FF0 and not 0xAC10 < c < 0xD7A0
               and not 0x17010 < c < 0x18AF0 and not 0x20010 < c < 0x33480]  # of long runs of like letters the first few
    texts = [t for c in letters for t in (f"x{c}.", f"{c}, a")]
    ids = Tokenizer.from_file(vocabulary(name)).encode_batch_fast(texts, add_special_tokens=False)
    got = encoding.Encoder(vocabulary(name)).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in ids]


def test_cache_is_bounded_and_long_units_are_not_kept(vocabulary, monkeypatch):
    monkeypatch.setattr(encoding, "MAX_CACHED", 20)
    enc = Encoder(vocabulary("byte_bpe_50k.json"))
    enc.encode(["z" * 200 + ", short"])
    assert set(enc.cache) == {" short", ","}
    enc.encode([" ".join(f"w{i}" for i in range(40))])
    assert len(enc.cache) <= 20


def test_shared_head_is_bounded_and_changes_no_ids(spark, documents, vocabulary):
    path = vocabulary("word_bpe_49k.json")
    docs = documents([(i, " the Cat," * 9 + f" w{i} <|endoftext|>" * (i % 2), "en") for i in range(40)] + [(99, None, None)])
    head = encoding.share_frequent(docs, path, head=2).sent.value
    assert {" the", " Cat,"} <= set(head) and len(head) <= 2 * 3 + 1
    texts = ["the cat, a Cat, dog", " the", "İ? the"]
    assert Encoder(path, head).encode(texts) == Encoder(path).encode(texts)
    assert encoding.share_frequent(documents([]), path).sent.value == {}


def test_the_driver_loads_no_tokenizer_for_the_head(vocabulary, documents, monkeypatch):
    path = vocabulary("word_bpe_49k.json")
    docs = documents([(i, f"often Often, rare{i} {'w' * 60}", "en") for i in range(20)] + [(21, None, "en")])

    def loaded(*_):
        raise AssertionError("the driver loads a tokenizer")

    monkeypatch.setattr(encoding, "Encoder", loaded)
    head = encoding.share_frequent(docs, path).sent.value
    monkeypatch.undo()
    assert {" Often,", "often", " rare3"} <= set(head) and not any("www" in u for u in head)
    enc = Encoder(path)
    assert all(enc.encode([u]) == [ids] for u, ids in head.items())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-2**63, 2**63 - 1)),
                          st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**32 - 1)), max_size=700)), min_size=1, max_size=6))
def test_segment_round_trip(docs):
    ids = [np.array(x, "<u4").tobytes() for _, x in docs]
    frame = token_blocks.encode_segment([d for d, _ in docs], ids)
    file = io.BytesIO(token_blocks.MAGIC + struct.pack("<H", token_blocks.BLOCK) + frame)
    assert list(token_blocks.read_segments(file)) == [([d for d, _ in docs], ids)]


def test_outliers_are_patched_and_blocks_get_small():
    ids = np.array(([5] * 250 + [4_000_000_000] * 6) * 8, "<u4").tobytes()
    frame = token_blocks.encode_segment([1], [ids])
    assert len(frame) < len(ids) / 8
    assert token_blocks.decode_segment(frame[12:]) == ([1], [ids])


def test_damage_is_noticed():
    good = token_blocks.MAGIC + struct.pack("<H", token_blocks.BLOCK) + token_blocks.encode_segment([1], [b"\1\0\0\0" * 9])
    for bad in (good[:-3], good[:-1] + bytes([good[-1] ^ 1]), b"XX" + good[2:]):
        with pytest.raises(ValueError):
            list(token_blocks.read_segments(io.BytesIO(bad)))


def test_round_trip_of_documents(spark, documents, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    rows = [(5, "later words", "en"), (None, "no id", "en"), (2, None, None), (3, "", "en"), (4, "long text " * 20_000, "en"),
            (9, "twice", "en"), (9, "twice", "en"), (9, "another", "de")]
    back = token_blocks.token_blocks_round_trip(documents(rows), path, 2).collect()
    enc = Encoder(path).tokenizer
    at, want = 0, []
    for d, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*enc.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        want.append((d, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in back), key=lambda r: r[1]) == want


def test_empty_table_and_no_end_id(spark, documents, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    assert token_blocks.token_blocks_round_trip(documents([]), path, 2).count() == 0
    rows = token_blocks.token_blocks_round_trip(documents([(1, None, "en")]), path, None).collect()
    assert [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in rows] == [(1, 0, 0, b"")]


def test_query_equals_brute_force(spark, vocabulary):
    from wardlens.llm.queries import op1_token_blocks

    enc = Encoder(vocabulary("byte_bpe_50k.json")).tokenizer
    docs = sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    at, want = 0, []
    for d, t in docs:
        ids = np.array([*enc.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()
        want.append((d, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert sorted(map(tuple, op1_token_blocks(spark, SF_SMALL).collect())) == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_shared_before_any_punctuation_and_go_to_the_model(vocabulary, name, monkeypatch):
    import pyarrow as pa

    enc, asked = Encoder(vocabulary(name)), []
    texts = [" größe$$$ größe### größe größe", "", " (word) word_ wówów\nit's*", "\n", " x'll] Ünï| ŉ% ĿL& ßß\"'s q'^ a`b~"]
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    library = enc._library
    monkeypatch.setattr(enc, "_library", lambda parts: asked.extend(parts) or library(parts))
    assert enc.encode(pa.array(["cut off", *texts], pa.string()).slice(1)) == want
    assert {"$$$", "###"} <= set(asked) and not {" größe", " größe$$$", " wówów"} & set(asked)
    words = ["".join(random.Random(k).choices(encoding._LETTERS, k=1 + k % 60)) for k in range(600)]
    mixed = [" ".join(words), "\t".join(w + random.Random(w).choice(list(encoding._STOPS)) * 2 for w in words)]
    assert enc.encode(mixed) == [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(mixed, add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_parts_are_cut_as_bytes_without_white_space_and_case(vocabulary, name):
    import re

    import pyarrow as pa

    enc, rng = Encoder(vocabulary(name)), random.Random(8)
    texts = ["", "...", "x..", "...", "The the\n\nTHE, The.) été. É", " \n", "a", *("".join(rng.choices(" \n\t.,-'aBcé1", k=30)) for _ in range(400))]
    parts, index, first = encoding.cut_parts(pa.array(["cut off", *texts], pa.large_string()).slice(1), enc.folds)
    stops = re.escape(encoding._STOPS)
    for t, a, b in zip(texts, first, first[1:], strict=False):
        want = [p for u in re.findall(r"[ \n\t]+[^ \n\t]*|[^ \n\t]+", t) for p in re.split(f"(?<=[A-Za-z])(?=[{stops}]+$)", u)]
        if enc.folds:
            want = [(p.strip(" \n\t") or p).lower() if p.isascii() else p for p in want]
        assert [parts[k] for k in index[a:b]] == want
    assert len(first) == len(texts) + 1 and first[-1] == len(index)
    assert enc.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_capitals_and_letters_before_stops_go_to_the_model_and_are_shared(vocabulary, monkeypatch):
    enc, asked = Encoder(vocabulary("word_bpe_49k.json")), []
    texts = ["Some some\nSOME some, Größe\nGröße café, café. ÉTÉ!"]
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    library = enc._library
    monkeypatch.setattr(enc, "_library", lambda parts: asked.extend(parts) or library(parts))
    assert enc.encode(texts) == want
    assert set(asked) == {",", ".", "!"} and not {" some", "\nSOME", " some,"} & set(enc.cache)
