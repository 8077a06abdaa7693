"""Run registered queries at one scale factor and compare with the oracles.

usage: python tools_check.py [sf_dir] [name-prefix ...]
"""

import json
import sys
import time

from firn.plans import registry
from firn.plans.compare import compare, duck_connect
from firn.session import build_session


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    registry.load_all()
    spark = build_session()
    con = duck_connect(sf_dir)
    bad = 0
    for name, fn in registry.QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in registry.ORACLES:
                res = compare(df, con, registry.ORACLES[name])
            else:
                res = {"spark_rows": df.count(), "ok": None}
        except Exception as e:  # report and go on
            res = {"ok": False, "error": str(e)[:600]}
        res["sec"] = round(time.time() - t0, 2)
        bad += res.get("ok") is False
        print(name, json.dumps(res, default=str), flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main()
