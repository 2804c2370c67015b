"""Headline timings. Prints one JSON line.

BENCH_SF_DIR selects the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8).
Each query is fully computed into a discarding sink, once untimed so that classes are loaded and code is
compiled, then timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from postlens.plans.catalog import QUERIES
from postlens.session import local_session

HEADLINE = (
    "enrich_posts", "normalize_text", "sentiment_score", "entities_all", "entities_negative_event",
    "geo_lookup", "tokenize_words", "normalize_slang", "word_frequency", "stem_tokens", "spell_correct",
    "encode_sequence", "embedding_pool", "flatten_tweet", "flatten_instagram", "db_row_tweet",
    "class_counts_history", "running_counts", "dedup_by_id", "batch_counts", "stream_running_counts",
    "stream_enrich", "enrich_posts_large", "normalize_slang_large", "classifier_score",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), name="bench")
    names = sys.argv[1:] or HEADLINE
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("count(*) AS n", "sum(octet_length(text)) AS bytes").first()
    documents = texts.n
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = run(spark, name, sf_dir)
    scale = Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total headline query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "documents": documents,
                "documents_per_sec": {
                    name: round(documents / seconds[name]) for name in ("enrich_posts", "stream_enrich") if name in seconds
                },
                "text_mb_per_sec": {
                    name: round(texts.bytes / 1e6 / seconds[name], 2)
                    for name in ("enrich_posts", "enrich_posts_large", "stream_enrich") if name in seconds
                },
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
