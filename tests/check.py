"""Run every registered query against its SQL: python -m tests.check [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import __spark_entry__ as entry
from parley.session import build_session
from tests.comparing import connect, differences


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        spark__master="local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = differences(entry.queries()[name](spark, sf_dir), con, oracles[name])
        except Exception as e:  # noqa: BLE001
            found = [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(found)
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - start:.2f}s", *found, sep="\n     " if found else " ")
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
