"""What the physical plans of the registered queries must not hold, and what they must push down."""

import re

import pytest

from cantolith.plans import registry

SF = "/root/testdata/sf0.001"
# HTML parsing, a two-dimensional dynamic program, and a provider that is Python itself.
PYTHON = {"align_words", "align_marked", "cursor_track_ids", "config_table", "html_pairs", "html_rows", "html_groups", "html_cells", "message_records"}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_nested_loops_and_python_only_where_needed(spark, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("NestedLoop|Cartesian", plan)
    assert bool(re.search("Python|Pandas|InArrow", plan)) == (name in PYTHON)


def test_scans_read_needed_columns_only(spark):
    plan = registry.QUERIES["coverage_ratio"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan
    plan = registry.QUERIES["slug_dedup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<page_id:bigint,html:string>", plan)


def test_windows_of_a_document_share_a_shuffle(spark):
    for name, most in (("karaoke_lines", 2), ("context_frame", 1)):
        plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= most, name


@pytest.mark.parametrize("name", ["interpolate", "monotonic_words", "starts", "monotonic_frames", "fill_between", "before", "line_changes"])
def test_scans_shuffle_rows_once_and_never_by_document_alone(spark, name):
    """Only the blocks' states meet by document; rows are dealt by document and block."""
    from cantolith.operators import sequences, timeline

    rows = spark.read.parquet(f"{SF}/events.parquet").selectExpr("user_id AS doc_id", "event_id AS word_idx", "event_id AS tick", "event_id AS seg_id", "value AS start_s", "value AS end_s", "value AS duration", "value AS t_s", "event_type AS line")
    df = timeline.before(rows, rows, 1.0) if name == "before" else getattr(sequences if name == "line_changes" else timeline, name)(rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    by = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    alone = [x for x in by if x.count("#") == 1]
    assert by and all("_b" in x for x in by if x not in alone), by
    assert len(alone) <= 1, (alone, name)  # the states of blocks


def test_hours_are_made_after_the_last_shuffle(spark):
    """Runs of equal hours are repaired, not hours: no exchange stands over the sequence of them."""
    for name in ("time_grid_active", "timeline_monotonic", "active_timeline"):
        plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        at = next(k for k, x in enumerate(plan.splitlines()) if "Generate explode(sequence(" in x)
        assert not any("Exchange" in x for x in plan.splitlines()[:at]), name
