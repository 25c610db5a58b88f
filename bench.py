"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: input folder. BENCH_CPUS: local cores. BENCH_QUERIES: comma-separated subset.
"""

from __future__ import annotations

import json
import os
import re
import time

from duolex.plans.catalog import all_queries
from duolex.session import build_session

HEADLINE = [
    "job_clean_corpus", "agg_step_table", "distinct_pairs_keep_first", "job_decontaminate", "job_segment_process",
    "job_step4_sentence_split", "job_train_langid", "job_score_langid", "job_quality_features", "metric_wer",
    "metric_cer", "metric_f_measure", "model_quality_evaluate", "job_learn_subwords_char", "job_learn_subwords_word",
    "job_apply_subwords_char", "topk_vocab", "win_token_batches",
    "job_build_training_set", "win_fixed_batches", "topk_nbest", "lookup_phrase_table", "job_batch_translate",
    "lookup_lexicon", "sink_routed_clustered", "win_token_batches_full",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "duolex-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    # The first query of a session pays for starting the engine and its workers.
    queries["metric_wer"](spark, folder).limit(1).write.format("noop").mode("overwrite").save()
    times = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None}))
    spark.stop()


if __name__ == "__main__":
    main()
