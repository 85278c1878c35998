"""Time the headline queries; prints one JSON line.

Each query runs twice: the first run warms the JVM and is reported as ``cold``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from treeseek import registry  # noqa: E402
from treeseek.registry import data  # noqa: E402
from treeseek.session import build_session  # noqa: E402

HEADLINE = (
    "postings", "term_stats", "fulltext_or", "fulltext_and", "fulltext_prefix", "phrase", "fulltext_not",
    "bm25_topk", "bm25_buckets", "function_score", "highlight", "more_like_this", "suggest", "did_you_mean",
    "html_buckets", "asset_fields", "fulltext_rollup", "rollup_postings", "tree_rollup", "projection",
    "tree_paths", "subtree_filter", "type_filter", "specialise_dimensions", "workspace_overlay", "doc_ids",
    "ranges", "bool_or", "min_should", "geo_within", "geo_sort", "page_sorted", "multi_sort",
    "terms_agg", "nested_terms", "multi_agg", "stats", "upsert_latest", "stream_upsert", "incremental_rollup",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="treeseek-bench-")
    spark = build_session(
        "treeseek-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.sql.files.maxPartitionBytes": "8m",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": folder,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load()
    wanted = sys.argv[1:] or HEADLINE
    builds = {
        "index_build": lambda: data.document_index(spark, sf_dir),
        "page_index_build": lambda: data.page_index(spark, sf_dir),
        "tree_build": lambda: data.tree(spark, sf_dir),
    }
    cold, seconds = {}, {}
    for times in (cold, seconds):
        data.forget()
        for name, build in builds.items():
            times[name] = timed(build)
    for name in wanted:
        for times in (cold, seconds):
            times[name] = timed(lambda name=name: run(registry.QUERIES[name](spark, sf_dir)))
    docs = data.table(spark, sf_dir, "documents").count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "cold": {k: round(v, 3) for k, v in cold.items()},
                "docs_per_second": round(docs / seconds["index_build"], 1),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
