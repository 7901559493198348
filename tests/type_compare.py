"""Compare column types of every check (Spark) with its oracle (DuckDB)."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
       "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def spark_to_duck(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper().replace(" ", "")
    return MAP.get(t, t.upper())


def main() -> int:
    import __spark_entry__ as E
    from oracle_compare import duck

    from vigil.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    con = duck(sf)
    q, o = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(o):
        st = {f.name: spark_to_duck(f.dataType.simpleString()) for f in q[name](spark, sf).schema.fields}
        dt = {r[0]: r[1].replace(" ", "") for r in con.execute(f"DESCRIBE {o[name]}").fetchall()}
        diff = {k: (st.get(k), dt.get(k)) for k in set(st) | set(dt) if st.get(k) != dt.get(k)}
        if diff:
            bad += 1
            print(name, diff)
    print("type mismatches:", bad)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
