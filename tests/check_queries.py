"""Command line check: python tests/check_queries.py SF_DIR [NAME ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from inkprint.session import build_session  # noqa: E402
from tests.oracle import connect, difference  # noqa: E402


def main() -> None:
    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            note = difference(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            note = f"{type(error).__name__}: {str(error).strip()[:600]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        ok = note is None or note.startswith("rows only")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - started:.1f}s {note or ''}", flush=True)
    print(f"{failed} failed of {len(names or queries)}")


if __name__ == "__main__":
    main()
