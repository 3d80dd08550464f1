"""Command-line check: python -m tests.run_oracle [key-prefix ...] [--sf 0.01]"""

import sys
import time

from sparkmart.plans.registry import all_queries
from sparkmart.session import local_session
from tests.oracle import compare, connect


def main():
    args = sys.argv[1:]
    sf = "0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        del args[i : i + 2]
    folder = f"/root/testdata/sf{sf}"
    spark, con = local_session(), connect(folder)
    ok = bad = 0
    for key, q in all_queries().items():
        if args and not any(key.startswith(a) for a in args):
            continue
        t = time.time()
        try:
            if q.sql:
                diff = compare(spark, con, q, folder)
            else:
                n = q(spark, folder).count()
                diff = None if n else "EMPTY"
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:900]}"
        took = time.time() - t
        if diff:
            bad += 1
            print(f"FAIL {key} {took:.1f}s {diff}", flush=True)
        else:
            ok += 1
            if took > 5:
                print(f"slow {key} {took:.1f}s", flush=True)
    print(f"ok={ok} bad={bad}")


if __name__ == "__main__":
    main()
