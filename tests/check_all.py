"""Run every query against its SQL: ``python tests/check_all.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import tempfile
import time
import traceback
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from oracle import connect, differences  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from loanweave.session import build_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", 8, spark__checkpoint__dir=tempfile.mkdtemp(prefix="loanweave-check-"))
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, failed = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                problems = differences(run(spark, sf_dir), connection, oracles[name])
            else:
                problems = [] if run(spark, sf_dir).count() else ["no rows"]
        except Exception:
            problems = [traceback.format_exc(limit=-4)[-1500:]]
        failed += bool(problems)
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {' | '.join(problems)[:1500]}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
