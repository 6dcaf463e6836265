"""Run registered queries against their reference SQL: ``check.py [-d dir] [-m module] [name ...]``."""

from __future__ import annotations

import argparse
import importlib
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from weftline.plans import TABLE_NAMES, everything  # noqa: E402
from weftline.session import build_session  # noqa: E402


def say(*parts):
    print(*parts, flush=True)


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return repr(v)




def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("-d", default="/root/testdata/sf0.01")
    ap.add_argument("-m", action="append")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    if args.m:
        qs, sqls = {}, {}
        for m in args.m:
            c = importlib.import_module(f"weftline.plans.{m}").catalog
            qs.update(c.queries)
            sqls.update(c.sql)
    else:
        c = everything()
        qs, sqls = c.queries, c.sql
    if args.names:
        qs = {k: v for k, v in qs.items() if any(k.startswith(n) for n in args.names)}
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                            "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from '{args.d}/{t}.parquet'")
    bad = 0
    for k, fn in qs.items():
        t0 = time.time()
        try:
            df = fn(spark, args.d)
            rows = df.collect()
        except Exception as e:  # report and go on with the next query
            say(f"FAIL  {k}: {str(e)[:700]}")
            bad += 1
            continue
        t1 = time.time()
        if k not in sqls:
            say(f"rows  {k}: {len(rows)} rows {t1 - t0:.1f}s")
            continue
        try:
            cur = con.execute(sqls[k])
            names = [d[0] for d in cur.description]
            types = {d[0]: str(d[1]) for d in cur.description}
            want = cur.fetchall()
        except Exception as e:
            say(f"FAIL  {k} (sql): {str(e)[:700]}")
            bad += 1
            continue
        t2 = time.time()
        order = sorted(df.columns)
        if sorted(names) != order:
            say(f"FAIL  {k}: columns {order} vs {sorted(names)}")
            bad += 1
            continue
        got = sorted(str([plain(r[c]) for c in order]) for r in rows)
        exp = sorted(str([plain(r[names.index(c)]) for c in order]) for r in want)
        kinds = {c: (dict(df.dtypes)[c], types[c]) for c in order}
        odd = {c: v for c, v in kinds.items() if v not in ALIKE and not v[0].startswith("array")}
        if got != exp:
            bad += 1
            a, b = set(got) - set(exp), set(exp) - set(got)
            say(f"DIFF  {k}: {len(got)} vs {len(exp)} rows; {len(a)}/{len(b)} differ {order}")
            say("   spark:", [x[:600] for x in sorted(a)[:2]])
            say("   sql:  ", [x[:600] for x in sorted(b)[:2]])
        else:
            say(f"ok    {k}: {len(got)} rows {t1 - t0:.1f}s (sql {t2 - t1:.1f}s)" + (f"  TYPES {odd}" if odd else ""))
    say("bad:", bad)


ALIKE = {("bigint", "BIGINT"), ("string", "VARCHAR"), ("double", "DOUBLE"), ("int", "INTEGER"),
         ("boolean", "BOOLEAN"), ("timestamp_ntz", "TIMESTAMP")}

if __name__ == "__main__":
    main()
