"""Time the oracle SQL of the headline queries in DuckDB (single-node yardstick).

    python tools/duck_bench.py [--sf /root/testdata/sf0.1] [--threads 8]
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--threads", type=int, default=8)
    args = ap.parse_args()

    from bench import HEADLINE
    from tidewater.plans import registry
    from tools.check_oracle import duck

    con = duck(args.sf)
    con.execute(f"SET threads = {args.threads}")
    sqls = registry.oracle_sql()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        # hash every column so that no projection can be skipped
        con.execute(f"SELECT count(*), sum(hash(COLUMNS(*))) FROM ({sqls[name]}) q").fetchall()
        times[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "duckdb_oracle_total_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": args.sf}))


if __name__ == "__main__":
    main()
