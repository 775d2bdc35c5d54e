"""Run bound queries against their oracles: check.py [sf or folder] [key ...]."""

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 2)[0])

import __spark_entry__ as contract
from millrace.session import local_session
from tests.oracle import connect, differences


def main() -> int:
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    root = scale if "/" in scale else f"/root/testdata/sf{scale}"
    queries, oracles = contract.queries(), contract.oracle_sql()
    keys = sys.argv[2:] or list(queries)
    spark, connection, failed = local_session(), connect(root), []
    for key in keys:
        start = time.time()
        try:
            result = queries[key](spark, root)
            problems = (
                differences(result, connection, oracles[key])
                if key in oracles
                else ([] if result.count() > 0 else ["no rows"])
            )
        except Exception as error:  # report and go on
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        mark = "ok" if not problems else "FAIL"
        print(f"{mark:4} {key:24} {time.time() - start:6.1f}s {'' if key in oracles else '(rows only)'}", flush=True)
        for problem in problems:
            print("     ", problem[:2500])
        if problems:
            failed.append(key)
    print(f"{len(keys) - len(failed)}/{len(keys)} passed", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
