"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from weirflow.session import local_session

HEADLINE = (
    "src_2_cursor_scan", "src_3_admit_batch", "src_4_keyset_scan", "src_6_multi_window_scan", "src_12_keyed_watermarks_rows",
    "src_13_changed_parents", "src_18_unwrap_records", "src_23_balance_bins", "snk_2_scd1_upsert", "snk_3_scd1_delete",
    "snk_4_scd2_history", "snk_4_scd2_late_rows", "snk_5_scd2_delete", "snk_7_snapshot_scd2", "snk_8_cluster_by",
    "prj_1_coerce", "prj_9_split_properties", "fn_7_parse_hl7_dtm", "fn_17_scrub_emails", "exp_4_series_to_rows", "exp_6_tree_walk",
    "joi_1_fan_out_children", "joi_7_asof_value", "joi_8_overlap_pairs", "agg_1_report", "agg_4_active_users",
    "agg_5_session_avg_length", "agg_10_ts_summary", "agg_12_ts_plot", "agg_18_dedupe_by_best_key", "win_2_sessionize",
    "win_3_position_index", "win_5_ts_interpolate", "str_3_upsert_stream", "hl7_4_segment_table_obx", "hl7_4_segment_table_pid",
    "fhir_3_datatypes", "dcm_1_series_instances", "dq_6_uncovered_fields", "dq_9_partitions_stable",
)


LONG_SECONDS = 5


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    from weirflow.plans.catalogue import QUERIES

    # The first query of a session pays for starting up; it is not part of the numbers.
    QUERIES["src_1_snapshot_scan"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only or HEADLINE:
        runs = []
        # The median of three; a query beyond LONG_SECONDS runs once, its share of noise is small.
        while len(runs) < 3 and not (runs and runs[0] > LONG_SECONDS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs), 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
