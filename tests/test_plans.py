"""The physical plans have the shape the scale design relies on."""

import contextlib
import io
import re

import pytest

from tests.conftest import SF_SMALL
from tickweave.operators.aggregates import window_counts, window_metrics
from tickweave.operators.changes import window_changes
from tickweave.operators.indicators import window_report
from tickweave.operators.ranking import top_k
from tickweave.operators.scan import affine_scan
from tickweave.sources.tables import load_quotes


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def quotes(spark):
    return load_quotes(spark, SF_SMALL)


def test_window_metrics_prunes_columns_and_combines_map_side(quotes):
    p = plan(window_metrics(quotes))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas and all(set(f.split(":")[0] for f in s.split(",")) ==
                           {"event_id", "ts", "event_type", "value", "props"} for s in schemas)
    assert "PushedFilters: [IsNotNull(ts)]" in p
    simple = plan(window_metrics(quotes), "simple")
    assert simple.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in simple and "SortAggregate" not in simple


def test_changes_split_hot_keys_by_time_bucket_and_hash_aggregate(quotes):
    p = plan(window_changes(quotes, "1 day", "12 hours"), "simple")
    assert re.search(r"Exchange hashpartitioning\(symbol#\d+, _bucket#\d+", p)
    # Only the runs of buckets are gathered, at most window / bucket of them; bars never are.
    assert p.count("collect_list(struct(s, _bucket") == 2 and p.count("collect_list") == 2


def test_report_is_one_aggregation_over_the_changes(quotes):
    p = plan(window_report(quotes, "1 day", "12 hours"), "simple")
    assert len(re.findall(r"HashAggregate\(keys=\[window#\d+, symbol", p)) == 2   # partial + final
    assert "SortAggregate" not in p


def test_top_k_limits_each_group_before_the_shuffle(quotes):
    p = plan(top_k(window_metrics(quotes), "avg_gain", 3), "simple")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_scan_groups_are_bounded_blocks(spark):
    df = spark.createDataFrame([("k", i, 0.5, 1.0) for i in range(10)], "k string, i int, a double, b double")
    p = plan(affine_scan(df, "k", ["i"], "a", ["b"], block=4), "simple")
    assert "_block" in p


def test_wide_sliding_windows_expand_bucket_summaries(quotes):
    p = plan(window_metrics(quotes, "1 hour", "5 minutes"), "simple")
    # Expand sits above the first (bucket) aggregation, not on the scanned rows.
    expand_at = p.index("Expand")
    assert p.count("Exchange hashpartitioning") == 2
    assert "HashAggregate" in p[expand_at:] and "FileScan" in p[expand_at:]
    lines = p.splitlines()
    expand_line = next(i for i, x in enumerate(lines) if "Expand" in x)
    below = "\n".join(lines[expand_line + 1:])
    assert below.index("HashAggregate") < below.index("FileScan")


def test_window_changes_sort_bars_once(quotes):
    for window, slide in (("10 minutes", "5 minutes"), ("1 hour", "5 minutes")):
        p = plan(window_changes(quotes, window, slide), "simple")
        lines = p.splitlines()
        assert sum("Sort [" in x for x in lines) == 1 and "Join" not in p and "Union" not in p
        # The runs are copied into windows, not the bars.
        expand = next(i for i, x in enumerate(lines) if "Expand" in x)
        assert "Sort [" in "\n".join(lines[expand + 1:])


def test_gaps_take_one_scan(quotes):
    p = plan(window_counts(quotes, fill_empty=True), "simple")
    assert p.count("FileScan") == 1 and p.count("HashAggregate") == 2
