"""Wall time of every query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once, its result drained by a no-op sink. The tables that several
queries share (comparisons, vocabularies, run steps, models) are written first and
timed on their own under "setup"; the value is the sum of both, and "with_setup" adds to a
query the tables it reads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pairloom.plans import inputs, run_queries
from pairloom.plans.catalog import QUERIES
from pairloom.session import build_session

SETUP = {
    "pairs": inputs.pairs,
    "chat_vocab": inputs.chat_vocab,
    "encoded_chats": inputs.encoded_chats,
    "logged_rollouts": inputs.logged_rollouts,
    "run_steps": inputs.run_steps,
    "doc_pairs": inputs.featured_doc_pairs,
    "split_pairs": run_queries._split_pairs,
    "reward_head": run_queries._head,
    "reference_lm": inputs.reference_lm,
    "policy_lm": inputs.policy_lm,
    "lm_scores": inputs.lm_scores,
}
#: The prepared tables that a query reads.
NEEDS = {
    **dict.fromkeys(("lm_eval_loss", "kl_watch"), ("reference_lm", "policy_lm", "lm_scores")),
    "reward_split": ("doc_pairs", "split_pairs"),
    **dict.fromkeys(("reward_fit", "reward_eval"), ("doc_pairs", "split_pairs", "reward_head")),
    **dict.fromkeys(("encode", "decode", "truncate", "attention_mask", "pad_batch", "causal_labels", "stack_batch"), ("pairs", "chat_vocab", "encoded_chats")),
    **dict.fromkeys(("prompt_budget", "rollout_rewards"), ("pairs", "chat_vocab", "logged_rollouts")),
    **dict.fromkeys(("accum_loss", "eval_loss", "metric_merge", "metric_format", "best_so_far", "best_checkpoint", "checkpoint_manifests"), ("run_steps",)),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(sys.argv[1:])
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().collect()

    setup, times = {}, {}
    if not only:
        for name, make in SETUP.items():
            start = time.perf_counter()
            make(spark, sf_dir)
            setup[name] = round(time.perf_counter() - start, 3)
    for name, run in QUERIES.items():
        if only and name not in only:
            continue
        start = time.perf_counter()
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()) + sum(setup.values()), 3),
                "unit": "sec",
                "queries": times,
                "setup": setup,
                "with_setup": {q: round(times[q] + sum(setup[s] for s in need if s in setup), 3) for q, need in NEEDS.items() if q in times},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
