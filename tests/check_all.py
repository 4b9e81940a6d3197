"""Run every registered query beside its check SQL:  python -m tests.check_all SF_DIR [name ...]"""

import sys
import time

from __spark_entry__ import oracle_sql, queries
from tests.compare import difference, oracle
from tests.conftest import session


def main(sf_dir: str, names: list[str]) -> int:
    spark, con = session(), oracle(sf_dir)
    sql, failed = oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                problem = difference(df, con, sql[name])
                verdict = "ok" if problem is None else f"DIFFERENT {problem}"
            else:
                problem, verdict = None, f"rows {df.count()}"
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            problem = verdict = f"ERROR {type(error).__name__} {str(error)[:1500]}"
        failed += problem is not None
        print(f"{time.time() - started:6.1f}s {name}: {verdict}", flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
