"""Physical-plan inventory of every registered query.

Runs each query, then reads its final adaptive plan through ``explain``
and counts the operators that decide cost at scale: shuffles by kind,
join strategies, broadcasts, aggregates, windows, and anything that
would put a whole input on one task (a single-partition exchange, a
cartesian product, a nested-loop join).

    python -m mercato.plans.inventory [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

COUNTED = {
    "hash_exchange": r"Exchange hashpartitioning",
    "range_exchange": r"Exchange rangepartitioning",
    "single_partition": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "shj": r"ShuffledHashJoin",
    "hash_agg": r"HashAggregate",
    "sort_agg": r"SortAggregate",
    "window": r"\bWindow\b",
    "cartesian": r"CartesianProduct|BroadcastNestedLoopJoin",
}


def final_plan(df) -> str:
    """``explain`` text of the plan as executed (AQE's final plan)."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def summarize(plan: str) -> dict[str, int]:
    body = plan.split("== Initial Plan ==")[0]
    return {k: len(re.findall(p, body)) for k, p in COUNTED.items()}


def main(argv):
    from mercato.plans.registry import all_queries
    from mercato.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    cols = list(COUNTED)
    print(f"# Physical plans of the registered queries ({sf_dir}, final AQE plans)\n")
    print("Counts per query of the operators that matter at scale. `single_partition` is an exchange that")
    print("moves all rows of its input to one task: it appears only under one-row aggregates (a global")
    print("`agg`) or the bounded inputs explained in README.md. `cartesian` must be 0 everywhere.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, q in sorted(all_queries().items()):
        try:
            s = summarize(final_plan(q.fn(spark, sf_dir)))
            print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | error: {str(e).splitlines()[0][:80]} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
