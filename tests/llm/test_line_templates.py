"""Recurring lines."""

import random

from llm_fixtures import documents  # noqa: F401
from wardlens.llm import line_templates as lt


def _rows():
    rows = [(i, f"Unique opening number{'abcdefgh'[i]} of this very text\nShare this page with your friends today\n"
                f"Posted on 2024-0{i + 1}-11 by user{i} in category news\nerror in module {'abcdefgh'[i]}x while reading the big input file here\nclosing {i}",
             "en") for i in range(5)]
    rows += [(10, None, "en"), (11, "", "en"), (12, "a b c\na b c", "en"), (13, "a b c", "en"), (14, "a b c", "en"),
             (None, "Share this page with your friends today", "en"), (15, "word " * 60_000 + "\n" + "Share this page with your friends today", "en"),
             (2, rows[2][1], "en")]
    return rows


def test_templates_are_dropped_from_all_but_the_first(documents):
    frame = documents(_rows())
    out = lt.drop_recurring_lines(frame, chars_col="n_chars", counts=True)
    got = {}
    for r in out.collect():
        assert got.setdefault(str(r.doc_id), r.text) == r.text
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert got["None"] == "Share this page with your friends today"  # a null id is the first
    assert got["10"] is None and got["11"] == "" and got["12"] == "a b c\na b c"  # too short to be templates
    assert got["0"] == _rows()[0][1].replace("Share this page with your friends today\n", "")
    for i in range(1, 5):
        assert got[str(i)] == f"Unique opening number{'abcdefgh'[i]} of this very text\nclosing {i}"
    assert got["15"].strip() == ("word " * 60_000).strip()


def test_generalised_template_needs_enough_documents(documents):
    line = "error in module {} while reading the big input file here"
    two = documents([(i, line.format("ab"[i] * 3), "en") for i in range(2)])
    assert lt.recurring_lines(two).count() == 0
    three = documents([(i, line.format("abc"[i] * 3), "en") for i in range(3)])
    assert sorted((r.doc_id, r.dropped) for r in lt.recurring_lines(three).collect()) == [(0, False), (1, True), (2, True)]


def test_repeated_rows_are_one_document(documents):
    assert lt.recurring_lines(documents([(1, "one two three four five", "en")] * 4)).count() == 0


def test_two_templates_in_one_leaf(documents):
    a = "one two three four alpha beta gamma delta {} epsilon"
    b = "one two three four north south east west {} middle"
    rows = [(i, a.format("klmnop"[i]), "en") for i in range(4)] + [(10 + i, b.format("qrstuv"[i]), "en") for i in range(3)]
    assert sorted(r.doc_id for r in lt.recurring_lines(documents(rows)).collect() if r.dropped) == [1, 2, 3, 11, 12]


def test_many_templates_in_a_leaf_of_one_off_lines(documents):
    """Votes of other lines and ties between templates must not lose a leaf's templates."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(4)) for _ in range(40)]
    rows = [(i, "one two three " + " ".join(rnd.choice(words) for _ in range(9)), "en") for i in range(150)]
    want = []
    for t, n in enumerate((3, 3, 4, 5)):
        body = [f"{'pqrs'[t]}{c}" for c in "abcdefgh"]
        for k in range(n):
            rows.append((1000 + 10 * t + k, "one two three " + " ".join([*body, "zyxwv"[k] * 6]), "en"))
            want += [1000 + 10 * t + k] * (k > 0)
    assert sorted(r.doc_id for r in lt.recurring_lines(documents(rows)).collect() if r.dropped) == want


def test_short_and_variable_lines_that_recur_as_they_are(documents):
    body = "All rights reserved.\n---\n{}\n2024-01-01 10:00 v1.2 user7\n© 2019"
    rows = [(i, body.format("abcd"[i]), "en") for i in range(4)] + [(9, "2024-01-02 10:00 v1.3 user7", "en")]
    got = {r.doc_id: r.text for r in lt.drop_recurring_lines(documents(rows)).collect()}
    assert got == {0: rows[0][1], 9: rows[4][1], **{i: f"---\n{'abcd'[i]}" for i in (1, 2, 3)}}


def test_columns_and_empty_table(documents):
    frame = documents([])
    assert lt.drop_recurring_lines(frame, chars_col="n_chars").columns == frame.columns
    assert lt.drop_recurring_lines(frame).count() == 0
    clash = frame.withColumnRenamed("uid", "N_Lines")
    out = lt.drop_recurring_lines(clash, counts=True)
    assert len({c.lower() for c in out.columns}) == len(out.columns)


def test_lines_of_many_texts_hash_as_those_of_each():
    import numpy as np
    from wardlens.llm.shingles import text_groups

    texts = [b"", b"one two three four\n\n ?! \nuser 12 has left", b"\n", b"short 1\none two three four\n1 2 3 4", "é ü 7 words more".encode()] * 3
    owner, numbers, line, leaf, codes = lt.line_hashes(texts)
    at = np.searchsorted(owner, np.arange(len(texts) + 1))
    for k, (a, b) in enumerate(zip(at, at[1:], strict=False)):
        _, *alone = lt.line_hashes([texts[k]])
        assert [list(x) for x in alone] == [list(x[a:b]) for x in (numbers, line, leaf, codes)]
    assert numbers[:2] == [0, 3] and codes[0] and not codes[2]
    assert list(text_groups(["ab", None, "c" * 9, "d"], 3)) == [(0, 3), (3, 4)] and list(text_groups([], 3)) == []


def test_repeated_lines_ids_and_nulls_in_one_group(spark, documents):
    own = ["red apples", "green pears and plums", "two", "a cart full of hay from a farm"]
    gone = "this line is in every text of all"
    rows = [(i, f"{own[i]}\n{gone}\n{gone}", "en") for i in range(4)] + [(None, gone, "en"), (None, None, None), (0, "", "en")]
    out = {(r["doc_id"], r["text"]): (r["n_lines"], r["n_dropped"]) for r in lt.drop_recurring_lines(documents(rows), counts=True).collect()}
    assert out == {(None, gone): (1, 0), (None, None): (0, 0), (0, ""): (0, 0),
                   **{(i, own[i]): (3, 2) for i in range(4)}}
