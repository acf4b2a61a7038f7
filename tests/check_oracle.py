"""Run registered queries against their oracle SQL: python -m tests.check_oracle [names]."""

from __future__ import annotations

import json
import sys
import time

from kinstar.plans.registry import ORACLE, QUERIES
from kinstar.session import local_session
from tests.compare import compare, duck


def main(argv: list[str]) -> int:
    sf_dir = "/root/testdata/sf0.01"
    names = argv or list(QUERIES)
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        t = time.time()
        df = QUERIES[n](spark, sf_dir)
        if n in ORACLE:
            res = compare(df, con, ORACLE[n])
        else:
            res = {"ok": True, "rows": df.count(), "oracle": None}
        res["sec"] = round(time.time() - t, 2)
        bad += not res["ok"]
        print(n, json.dumps(res, default=str), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
