"""Run proof queries next to their oracle SQL and report every difference.

    python tools/check_proofs.py [--sf sf0.001] [--times] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import os
import sys
import tempfile
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import types as T

from tallyloom.proofs import ORACLES, PLANS, Tables
from tallyloom.session import build_session

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SPARK_KINDS = {
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.ShortType: "SMALLINT",
    T.DoubleType: "DOUBLE",
    T.StringType: "VARCHAR",
    T.DateType: "DATE",
    T.BooleanType: "BOOLEAN",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP",
    T.BinaryType: "BLOB",
}


def plain(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, list):
        return tuple(map(plain, v))
    return v


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="sf0.001")
    ap.add_argument("--slow", type=float, default=5.0)
    ap.add_argument("--rows", action="store_true")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    sf_dir = f"/root/testdata/{args.sf}"
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tallyloom-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tallyloom-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for n in NAMES:
        con.execute(f"create view {n} as select * from '{sf_dir}/{n}.parquet'")
    todo = [n for n in PLANS if not args.names or any(n == a or n.startswith(a) for a in args.names)]
    bad = 0
    for name in todo:
        t0 = time.time()
        try:
            df = PLANS[name](Tables(spark, sf_dir))
            rows = df.collect()
            took = time.time() - t0
        except Exception as e:  # report and go on with the next query
            bad += 1
            print(f"FAIL {name}: {type(e).__name__}: {str(e)[:600]}")
            if args.rows:
                traceback.print_exc()
            continue
        note = f"  SLOW {took:.1f}s" if took > args.slow else ""
        if name not in ORACLES:
            print(f"rows {name}: {len(rows)} rows, no oracle{note}")
            continue
        try:
            res = con.execute(ORACLES[name])
            names = [d[0] for d in res.description]
            kinds = {d[0]: str(d[1]) for d in res.description}
            theirs = res.fetchall()
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: oracle: {str(e)[:600]}")
            continue
        problems = []
        if sorted(names) != sorted(df.columns):
            problems.append(f"columns {sorted(df.columns)} vs {sorted(names)}")
        else:
            for f in df.schema.fields:
                kind = SPARK_KINDS.get(type(f.dataType), f.dataType.simpleString())
                if kind != kinds[f.name]:
                    problems.append(f"type of {f.name}: {kind} vs {kinds[f.name]}")
            a, b = canon(rows, df.columns), canon(theirs, names)
            if len(a) != len(b):
                problems.append(f"rows {len(a)} vs {len(b)}")
            if a != b:
                sa, sb = set(a), set(b)
                diff = [("spark", x) for x in a if x not in sb][:3] + [("duck", x) for x in b if x not in sa][:3]
                problems.append(f"values differ in {len([x for x in a if x not in sb])} rows; cols {sorted(names)}: {diff}")
        if not rows:
            problems.append("no rows")
        if problems:
            bad += 1
            print(f"DIFF {name}: " + "; ".join(problems)[:1500])
        elif args.rows or note:
            print(f"ok   {name}: {len(rows)} rows{note}")
    print(f"{len(todo)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
