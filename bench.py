"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from tabwarden import catalogue

QUERIES = [
    "rule_ops_all", "rule_violations_by_month", "clean_stage_counts", "completeness", "validity", "type_check", "timeliness_gap", "profile_numeric", "profile_categorical", "case_conflicts", "assoc_pairs", "assoc_rules_top",
    "dynamic_rule_violations", "psi_numeric", "ks_statistic", "drift_status", "psi_categorical", "new_categories", "features_derived", "period_split", "dedupe_rows", "confusion_metrics", "auc_ranksum", "threshold_quantile", "tukey_ranges", "stratified_split",
    "scale_standard", "dynamics", "train_lr",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalogue.QUERIES["rule_ops_all"](spark, sf).collect()  # starts the JVM's threads and compiles the scan
    took = {}
    for name in QUERIES:
        began = time.time()
        catalogue.QUERIES[name](spark, sf).collect()
        took[name] = round(time.time() - began, 3)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "total seconds of headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
