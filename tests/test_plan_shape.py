"""Physical plans of the registered queries keep the shape the design relies on."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

FITTING = {"lr_certificate", "saved_scores", "grid_table", "cv_scores", "feature_importance", "score_admissions"}
NAMES = sorted(set(entry.queries()) - FITTING)

# lineitem columns no query uses; a scan reading them would mean no pruning.
UNUSED_LINEITEM = ("l_extendedprice", "l_discount", "l_tax")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_pairwise_join_and_prunes_columns(spark, name):
    text = plan_text(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "EvalPython" not in text               # no Python UDF of any kind
    for schema in re.findall(r"ReadSchema: (struct<[^\n]*>)", text):
        if "l_orderkey" in schema:
            assert not any(c in schema for c in UNUSED_LINEITEM), schema


def test_lab_scan_pushes_the_null_filter(spark):
    text = plan_text(entry.queries()["lab_window_24h"](spark, SF_SMALL))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
    assert any("IsNotNull(l_orderkey)" in p for p in pushed), pushed


def test_hot_sequence_plan_slices_only_when_a_key_is_hot(spark):
    from wardlens.operators.sequences import readmission_target
    from wardlens.sources import standin
    adm = standin.admissions(spark, SF_SMALL)
    assert "_wl_b" not in plan_text(readmission_target(adm, sort=False))
    assert "_wl_b" in plan_text(readmission_target(adm, hot_threshold=1, sort=False))
