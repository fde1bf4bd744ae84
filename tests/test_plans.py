"""Physical-plan checks: pushdown, pruning, no row-at-a-time Python, map-side
limits, broadcast only where bounded."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

Q = E.queries()


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


LAZY = [
    "six_hour_report", "gap_filled_series", "required_fields", "elem_match", "validate_documents",
    "assemble_documents", "inner_join", "semi_join", "anti_join_missing", "except_all_both", "recon_field_mismatches",
    "recon_batch_status", "field_value_profile", "split_title", "parse_prefixed_uuid", "enrichment_consumer",
    "chunk_words", "tokens_no_stopwords", "extract_entities", "autopopulate_codes",
]


@pytest.mark.parametrize("key", LAZY)
def test_no_row_at_a_time_python(spark, key):
    p = plan(Q[key](spark, SF_SMALL))
    assert "BatchEvalPython" not in p
    assert "ArrowEvalPython" not in p


def test_pandas_hook_is_arrow_batched(spark):
    p = plan(Q["pandas_decode"](spark, SF_SMALL))
    assert "ArrowEvalPython" in p and "BatchEvalPython" not in p


def test_time_window_filter_pushed_to_scan(spark):
    p = plan(Q["scan_time_window"](spark, SF_SMALL))
    assert "PushedFilters" in p and "o_orderdate" in p.split("PushedFilters")[1].splitlines()[0]


def test_projection_pruned_at_scan(spark):
    p = plan(Q["find_projection_range"](spark, SF_SMALL))
    schema_line = [ln for ln in p.splitlines() if ln.startswith("ReadSchema")][0]
    assert "value" not in schema_line and "props" not in schema_line and "user_id" not in schema_line


def test_topk_uses_map_side_group_limit(spark):
    p = plan(Q["tfidf_topk"](spark, SF_SMALL))
    assert p.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("key", ["tfidf_topk", "tfidf_topk_with_query", "best_chunk_per_doc", "embedding_topk_multi"])
def test_search_keeps_k_per_block(spark, key):
    """Blocks of texts meet blocks of queries in one group, which returns k rows
    per query: the rows go straight into the map-side limit, no pair table."""
    tree = plan(Q[key](spark, SF_SMALL)).split("\n\n")[0].splitlines()
    limits = [i for i, ln in enumerate(tree) if "WindowGroupLimit" in ln]
    block = next(i for i, ln in enumerate(tree) if "FlatMapCoGroupsInArrow" in ln)
    assert limits[1] < block
    assert not any("Exchange" in ln or "Join" in ln for ln in tree[limits[1] : block])


def test_no_broadcast_beyond_the_threshold(spark, no_broadcast):
    for key in ("tfidf_topk", "range_join_batches", "row_batches", "recon_all_batches"):
        tree = plan(Q[key](spark, SF_SMALL)).split("\n\n")[0]
        assert "NestedLoop" not in tree and "Cartesian" not in tree


def test_small_dimension_is_broadcast_by_spark(spark):
    p = plan(Q["broadcast_join"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p


def test_children_count_needs_no_unwind(spark):
    from pyspark.sql import functions as F

    from docflow.operators import nesting as N

    df = spark.createDataFrame([(1, ["R", "R", "A"])], "k int, a array<string>")
    p = plan(N.children_having_count(df, "a", lambda x: x == F.lit("R"), 2))
    assert "Exchange" not in p and "Generate" not in p


NO_PAIRS = LAZY + [
    "recon_all_batches", "range_join_batches", "gap_filled_series", "zero_fill_systems", "recon_two_sided",
    "recon_counts", "full_outer_merge", "embedding_topk_multi", "tfidf_topk", "tfidf_topk_with_query",
    "answer_cascade", "global_row_number", "row_batches", "id_range_batches", "growth_forecast",
]


@pytest.mark.parametrize("key", NO_PAIRS)
def test_no_cartesian_or_nested_loop(spark, key):
    p = plan(Q[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
