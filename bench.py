"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""
from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "target_versions", "prevalence_grouped", "flags_all", "join_pre_target", "clean_vitals", "clean_history",
    "clean_allergens", "lab_dispatch_wide", "band_impute_body", "text_standardise", "lookup_with_cache",
    "column_profile", "quality_report", "histogram", "p90_flag", "outlier_zscore", "flag_cooccurrence", "sort_top_n",
    "split_stratified", "kfold_stratified", "undersample_balance", "mutual_information", "univariate_auc_mwu",
    "roc_auc", "pr_auc", "classification_metrics", "threshold_sweep", "calibration_compare", "subgroup_errors",
    "case_review", "shap_linear", "shap_group_profiles", "fit_logistic", "score_batch",
]


def main() -> None:
    from cohortloom.queries import QUERIES
    from cohortloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    timings = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
