"""Driver contract: entry, queries, oracle keys."""

from __future__ import annotations

import __spark_entry__ as E

SURVEY_QUERIES = (
    "scan_lines gen_index_lines extract_bare extract_keyed extract_refs filter_http classify_network "
    "classify_file_type file_refs network_counts total_refs refs_by_network sample_20 sample_15 max_records "
    "batch_assign batch_counts table_columns table_exists write_append append_twice replace_date_twice "
    "reconcile summary_report run_result stream_file_refs url_parts format_hms file_inventory object_exists "
    "land_raw stream_progress"
).split()
NEW = "detailed_report replace_date_empty land_raw_emptied stream_table_refs".split()


def test_every_survey_query_is_registered():
    q = E.queries()
    assert set(SURVEY_QUERIES + NEW) <= set(q)
    assert set(E._ORACLE) == set(E._QUERIES) and set(E._QUERIES) <= set(q)


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.columns == [
        "reporting_entity_name", "reporting_entity_type", "plan_name", "plan_id", "plan_market_type",
        "file_url", "file_network", "file_type", "file_date", "extracted_ts"]
    assert df.count() == 2 * spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
