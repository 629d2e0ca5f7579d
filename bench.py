"""Time the headline queries; prints one JSON line.

Each query is run to its last row into Spark's no-op sink, so nothing is skipped and nothing is
collected. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` set the tables and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from reviewmill.plans.queries import REGISTERED
from reviewmill.session import local_session

HEADLINE = (
    "preprocess_summary",
    "stopword_filter",
    "topdf_filter",
    "build_vocab",
    "title_count_vectors",
    "count_vec_lines",
    "stem_map",
    "consolidate",
    "count_vectors",
    "tfidf",
    "mean_vectors",
    "weighted_vectors",
    "lemma_map",
    "ordinal_encode",
    "corr_matrix",
    "dist_by_class",
    "hist_by_class",
    "top_brand_rate",
    "yearly_counts",
    "numeric_features",
    "metadata_block",
    "feature_scopes",
    "stratified_folds",
    "macro_metrics",
    "roc_auc",
    "lift_by_scope",
    "lr_predict",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "reviewmill-bench")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{seconds[name]:8.2f} {name}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
