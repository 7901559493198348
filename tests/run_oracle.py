"""CLI: compare every (or the named) check against its oracle.

    python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402

from vigil.session import local_session  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = local_session(8)
    q, o = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(q):
        t = time.time()
        try:
            res = compare(spark, name, q[name], o.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            res = {"name": name, "ok": False, "error": f"{type(e).__name__}: {str(e)[:800]}"}
        res["sec"] = round(time.time() - t, 2)
        bad += not res["ok"]
        print(json.dumps(res, default=str))
    print(f"{len(names or q) - bad} ok, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
