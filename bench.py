"""Times headline queries end to end: each one builds its own vocabulary and encoded tables."""

from __future__ import annotations

import json
import os
import time

from textmill.plans import registry
from textmill.plans.workspace import forget
from textmill.session import local_session

HEADLINE = [
    "word_counts", "clean_pages", "sentence_segment", "shard_by_line", "assemble_vocab", "wordpiece", "encode_pairs",
    "assemble_examples", "build_examples", "replace_tokens", "token_offsets", "stride_windows",
    "coverage_report", "entity_scores", "metric_windows", "merge_rank_logs", "squad_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cores=cores, partitions=cores)
    known = registry.queries()
    # Warm the JVM up on one small query; nothing it builds is kept.
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    known["replace_tokens"](spark, small if os.path.isdir(small) else folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            forget()
            begin = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        seconds[name] = round(sorted(taken)[len(taken) // 2], 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": folder.rstrip("/").split("sf")[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
