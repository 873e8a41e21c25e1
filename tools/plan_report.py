"""Physical-plan summary of every registered batch query.

For each query: number of shuffle exchanges, how many of them move raw rows
(an exchange directly over a scan projection, i.e. not over a partial
aggregate), broadcast exchanges, sorts, window operators and joins, read
from the executed (AQE final) plan. ``--skewed`` runs the operators with a
tiny ``target_rows`` so the bucketed (hot-key) path is the one reported.

    python tools/plan_report.py [sf_dir] [--skewed]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def summarize(plan: str) -> dict:
    lines = plan.splitlines()
    ex = [i for i, line in enumerate(lines) if re.search(r"\bExchange (hash|single|range|round)", line)]
    raw = 0
    for i in ex:
        below = " ".join(lines[i + 1 : i + 4])
        if "Aggregate" not in below and "partial_" not in below:
            raw += 1
    count = lambda pat: sum(1 for line in lines if re.search(pat, line))
    return {
        "exchanges": len(ex),
        "raw_row_exchanges": raw,
        "broadcasts": count(r"BroadcastExchange"),
        "sorts": count(r"\bSort \["),
        "windows": count(r"\bWindow \["),
        "joins": count(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)"),
    }


def main(argv: list[str]) -> None:
    sf_dir = next((a for a in argv if not a.startswith("--")), "/root/testdata/sf0.1")
    skewed = "--skewed" in argv
    from chronokey.plans import scan
    from chronokey.queries import BATCH_QUERIES
    from chronokey.session import get_spark

    spark = get_spark("local[8]", **{"spark.checkpoint.dir": "/tmp/chronokey-plan-report"})
    if skewed:  # force the bucketed path everywhere
        spark.conf.set(scan.TARGET_ROWS_CONF, "10")
    spark.sparkContext.setLogLevel("ERROR")
    print(f"| query | exchanges | raw-row exchanges | broadcasts | sorts | windows | joins |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in BATCH_QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{name}` | {s['exchanges']} | {s['raw_row_exchanges']} | {s['broadcasts']} | {s['sorts']} | "
              f"{s['windows']} | {s['joins']} |", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
