"""Seconds per headline query on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

The nested pool is derived and stored first (``pool_build``); the queries over it read the stored
table, as a job over a pool in storage would. Each query runs once and writes to the noop sink, so that
every row and column is computed. Two rounds: the first warms the JVM up on the smallest data.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from profilerank.plans import fixture, queries_pool  # noqa: E402
from profilerank.plans.catalog import QUERIES  # noqa: E402
from profilerank.operators import features, model  # noqa: E402
from profilerank.schema import ID  # noqa: E402
from profilerank.session import get_session, new_path, scratch  # noqa: E402

HEADLINE = [
    "doc_compact", "doc_full", "text_bundle", "kw_hits", "kw_family_matrix", "feat_all", "rules_flag", "rule_histogram",
    "check_any", "interval_overlap_pairs", "summary_dist", "summary_dist_prices", "calibrate_thresholds",
    "global_rank", "global_rank_lines", "dedup_first", "demote_flagged", "merge_rankings", "gap_fill_topk", "stratified_split",
    "dataset_assemble", "avg_passes", "score_validate", "verdict_validate", "relevance_score", "metric_composite",
    "result_validate", "reason_text", "predict_pool", "train_ranker", "relevance_topk", "scoring_run", "stream_score", "flagship",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    seconds: dict[str, float] = {}
    for folder in ([warm_dir] if os.path.isdir(warm_dir) else []) + [sf_dir]:
        def run(name: str, action) -> None:
            start = time.perf_counter()
            action()
            seconds[name] = round(time.perf_counter() - start, 3)

        run("pool_build", lambda: fixture.pool(spark, folder))
        run("reference_date", lambda: queries_pool.reference(spark, folder))
        for name in HEADLINE:
            with scratch(spark):
                run(name, lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())
        with scratch(spark):
            path = new_path(spark, "features-csv")
            features.feat_all(fixture.pool(spark, folder), queries_pool.reference(spark, folder)).write.option("header", True).csv(path)

            def read_features() -> None:
                raw = spark.read.option("header", True).csv(path)
                model.coerce_features(raw, [c for c in raw.columns if c != ID]).write.format("noop").mode("overwrite").save()

            run("read_features_csv", read_features)
    records = fixture.pool(spark, sf_dir).count()
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "pool_records": records}))


if __name__ == "__main__":
    main()
