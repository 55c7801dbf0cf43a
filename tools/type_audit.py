"""List result-type differences between each case and its DuckDB oracle.

The driver compares schemas; this reports, per case, columns whose Spark type
family differs from DuckDB's (integer / float / decimal / string / temporal / bool).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle_check import duck  # noqa: E402


def family_spark(t: str) -> str:
    t = t.lower()
    if t == "bigint":
        return "int64"
    if t in ("int", "smallint", "tinyint"):
        return "int32"
    if t in ("double", "float"):
        return "float"
    if t.startswith("decimal"):
        return "decimal"
    if t in ("timestamp", "timestamp_ntz"):
        return "timestamp"
    return t


def family_duck(t: str) -> str:
    t = str(t).upper()
    if t in ("BIGINT", "HUGEINT", "UBIGINT"):
        return "int64"
    if t in ("INTEGER", "SMALLINT", "TINYINT", "UINTEGER"):
        return "int32"
    if t in ("DOUBLE", "FLOAT"):
        return "float"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    if t == "VARCHAR":
        return "string"
    if t == "BOOLEAN":
        return "boolean"
    if t == "DATE":
        return "date"
    return t.lower()


def main():
    from driftwood.plans.registry import load_all, queries
    from driftwood.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session()
    con = duck(sf)
    qs = queries()
    for k, c in load_all().items():
        if not c.sql:
            continue
        df = qs[k](spark, sf)
        st = {f.name: family_spark(f.dataType.simpleString()) for f in df.schema.fields}
        rel = con.sql(c.sql)
        dt = {n: family_duck(t) for n, t in zip(rel.columns, rel.types)}
        diff = {n: (st.get(n), dt.get(n)) for n in set(st) | set(dt) if st.get(n) != dt.get(n)}
        exact = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        if diff:
            print(k, diff, {n: exact.get(n) for n in diff}, flush=True)


if __name__ == "__main__":
    main()
