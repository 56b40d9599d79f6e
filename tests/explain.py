"""Print the plan Spark actually ran for registered queries.

``python -m tests.explain /root/testdata/sf0.1 daily_cost [more ...]``

Each query is executed first (its own query execution, so AQE's final plan
with runtime join choices is shown), then ``explain("formatted")``-style
output is printed. Add ``--summary`` for one line per operator of interest
(exchanges, joins, window limits, scans). ``--at-scale`` turns off the
size-based broadcasts (static and AQE) to show the plan a cluster gets when
readings, history and weather are far above the broadcast threshold; the
hinted literal rate table stays broadcast.
"""

from __future__ import annotations

import re
import sys

KEEP = re.compile(
    r"Exchange|Join|WindowGroupLimit|Window \[|FileScan|Scan |HashAggregate|SortAggregate|Expand|Generate|"
    r"BroadcastQueryStage|ShuffleQueryStage|AQEShuffleRead|InMemory|TakeOrdered"
)


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from gridlake.plans import bench_plans
    from gridlake.session import local_session

    summary = "--summary" in argv
    at_scale = "--at-scale" in argv
    argv = [a for a in argv if a not in ("--summary", "--at-scale")]
    sf_dir, names = argv[0], argv[1:]
    spark = local_session(8, 8)
    if at_scale:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    qs = E.queries()
    for n in names:
        q = qs.get(n) or getattr(bench_plans, n)
        df = q(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"===== {n}")
        if summary:
            final = plan.split("== Initial Plan ==")[0]
            for line in final.splitlines():
                if KEEP.search(line):
                    print(re.sub(r"#\d+L?", "", line)[:180])
        else:
            print(plan)


if __name__ == "__main__":
    main(sys.argv[1:])
