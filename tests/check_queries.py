"""Run registered queries against DuckDB: python tests/check_queries.py [sf] [name ...]."""

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from compare import connect, differences  # noqa: E402

from hubbub.plans import catalog  # noqa: E402
from hubbub.session import local_session  # noqa: E402


def main() -> int:
    scale, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{scale}"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = catalog.oracles()
    bad = 0
    for name, run in catalog.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                df = df.cache()
                df.count()
                spark_time = time.time() - start
                outcome = differences(df, con, oracles[name])
                df.unpersist()
                n = con.execute(f"SELECT count(*) FROM ({oracles[name]})").fetchone()[0]
            else:
                n, outcome = len(df.collect()), None
                spark_time = time.time() - start
        except Exception as error:  # report and go on with the next query
            outcome, n = f"{type(error).__name__}: {str(error)[:600]}", -1
            spark_time = 0.0
        bad += outcome is not None
        mark = "ok " if outcome is None else "BAD"
        kind = "" if name in oracles else " (rows only)"
        print(f"{mark} {name}{kind} rows={n} spark {spark_time:.1f}s all {time.time() - start:.1f}s {outcome or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
