"""Command line: the four batch steps and the streams.

  python -m lakeledger bronze  --pages landing/ --bronze t/bronze --ledger t/ledger
  python -m lakeledger silver  --bronze t/bronze --silver t/silver
  python -m lakeledger check   --silver t/silver
  python -m lakeledger export  --silver t/silver --target out/sheet --log t/synclog
  python -m lakeledger stream  --pages landing/ --bronze t/bronze --silver t/silver --checkpoint t/ck

Runs on the session ``spark-submit`` provides (or a local one).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from lakeledger.operators import jobs
from lakeledger.session import ensure_session_conf


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="lakeledger")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bronze")
    b.add_argument("--pages", required=True)
    b.add_argument("--bronze", required=True)
    b.add_argument("--ledger", required=True)
    b.add_argument("--prefix", default="")
    b.add_argument("--env", default="sandbox")
    b.add_argument("--permissive", action="store_true")
    b.add_argument("--quarantine")
    b.add_argument("--institution")
    b.add_argument("--item")
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--form", default="auto")
    c = sub.add_parser("check")
    c.add_argument("--silver", required=True)
    c.add_argument("--bronze")
    c.add_argument("--pages")
    e = sub.add_parser("export")
    e.add_argument("--silver", required=True)
    e.add_argument("--target", required=True)
    e.add_argument("--log", required=True)
    e.add_argument("--mode", default="current")
    e.add_argument("--env", default="sandbox")
    e.add_argument("--worksheet", default="transactions")
    e.add_argument("--mark", default="text", choices=("text", "typed", "built"))
    st = sub.add_parser("stream")
    st.add_argument("--pages", required=True)
    st.add_argument("--bronze", required=True)
    st.add_argument("--silver", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--prefix", default="")
    st.add_argument("--continuous", action="store_true")
    a = ap.parse_args(argv)

    spark = ensure_session_conf(SparkSession.builder.appName("lakeledger").getOrCreate())
    if a.cmd == "bronze":
        from lakeledger.operators import bronze as B
        out = B.ingest(spark, a.pages, a.bronze, a.ledger, prefix=a.prefix, default_env=a.env,
                       mode="PERMISSIVE" if a.permissive else "FAILFAST",
                       quarantine_path=a.quarantine, institution=a.institution, item_id=a.item)
    elif a.cmd == "silver":
        out = jobs.run_silver(spark, a.bronze, a.silver, form=a.form)
    elif a.cmd == "check":
        checks = jobs.run_checks(spark, a.silver, False, a.bronze, a.pages)
        rows = [r.asDict() for r in checks.collect()]  # a dozen rows
        print(json.dumps(rows, indent=2))
        return 0 if all(r["passed"] for r in rows) else 1
    elif a.cmd == "export":
        out = jobs.run_export(spark, a.silver, a.target, a.log, a.mode, a.env, a.worksheet, mark=a.mark)
    else:
        from lakeledger.streaming import streams
        q = streams.silver_stream(spark, a.pages, a.bronze, a.silver, a.checkpoint,
                                  prefix=a.prefix, available_now=not a.continuous)
        q.awaitTermination()
        out = {"stream": "done"}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
