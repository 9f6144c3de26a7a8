"""Run the subpackage's queries and their SQL twins side by side: ``python tests/llm/check_llm.py [sf] [name…]``."""

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main():
    from check_oracles import compare

    from catalogspark.llm.queries import ORACLES, QUERIES
    from catalogspark.session import local_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("0.") else "0.01"
    spark = local_session(**{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")})
    spark.sparkContext.setLogLevel("OFF")
    for name, fn in QUERIES.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        t = time.time()
        try:
            diff, n = compare(spark, f"/root/testdata/sf{sf}", name, fn, ORACLES.get(name))
        except Exception as e:  # noqa: BLE001 - reported per query
            diff, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        print("ok " if diff is None else "BAD", name, n, f"{time.time() - t:.1f}s", "" if name in ORACLES else "(no sql)", diff or "", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
