"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line with seconds per query."""

from __future__ import annotations

import json
import os
import sys
import time

from tallygrain.plans import catalog
from tallygrain.session import local_session

HEADLINE = [
    "dq_error_by_provider", "dq_rule_scorecard", "dq_dedup_key_keep_one", "dq_percentile_grid", "dq_box_stats", "sink_orc_partitioned", "agg_conditional_avg",
    "agg_multi_by", "join_agg_back", "topk_group_company", "win_dense_rank_topk", "ts_trend_season_forecast", "ts_ses", "rec_user_similarity", "rec_eval_topn", "rec_eval_kfold",
    "ml_cutoff_sweep", "ml_decile_lift", "ml_logit_fit", "txt_word_frequency", "txt_doc_term", "txt_lda",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=max(8, cpus), memory=os.environ.get("BENCH_MEMORY", "16g"))
    catalog.QUERIES["agg_count_by"](spark, folder).collect()  # start-up outside the measurements
    seconds = {}
    for name in wanted:
        started = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
