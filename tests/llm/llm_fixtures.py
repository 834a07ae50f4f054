"""Fixtures and paths shared by these tests."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture()
def documents(spark):
    """Build a documents table with extra columns whose names clash with working names."""

    def build(rows):
        schema = ("doc_id long, text string, lang string, source string, n_chars long, "
                  "uid long, `class` string, row long, digest string, n_words long, kept boolean, seq long, _drop string")
        return spark.createDataFrame(
            [(d, t, lang, None, None if t is None else len(t), 7, "x", None, "y", 3, None, 1, "z") for d, t, lang in rows], schema)

    return build


@pytest.fixture()
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path
