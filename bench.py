"""Benchmark the headline queries. Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_MODELS=0 to skip model training.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskforge.plans import catalog as C  # noqa: E402
from riskforge.session import build_session  # noqa: E402

HEADLINE = [
    # (name, query key or callable, how to run it)
    ("wide_orders", lambda s, d: C.wide(s, d), "count"),
    ("derive_table", lambda s, d: C.derived(s, d), "count"),
    ("feature_eval", "feature_eval", "collect"),
    ("woe_bins", "woe_bins", "collect"),
    ("monthly_metrics", "monthly_metrics", "collect"),
    ("source_eval", "source_eval", "collect"),
    ("profile", "profile", "collect"),
    ("category_profile", "category_profile", "collect"),
    ("split_model", "split_model", "noop"),
    ("derive_all_templates", "derive_table", "noop"),
    ("auc_ks", "auc_share", "collect"),
    ("models", "model_metrics", "collect"),
    ("report_features", "report_features", "collect"),
]


def run(df, how):
    if how == "collect":
        return len(df.collect())
    if how == "count":
        return df.count()
    df.write.format("noop").mode("overwrite").save()
    return None


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    models = os.environ.get("BENCH_MODELS", "1") != "0"
    spark = build_session(cpus, memory="16g")
    times = {}
    t_all = time.time()
    for name, q, how in HEADLINE:
        if name == "models" and not models:
            continue
        t = time.time()
        fn = C.QUERIES[q] if isinstance(q, str) else q
        run(fn(spark, sf_dir), how)
        times[name] = round(time.time() - t, 3)
    total = round(time.time() - t_all, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
