"""Command line: ``python -m checks.run [sf] [name-prefix ...]`` compares queries with their SQL."""

from __future__ import annotations

import sys
import time

from voltweave import build_session


def main(argv: list[str]) -> int:
    sys.path.insert(0, "tests")
    from compare import connect, difference

    import checks.catalog  # noqa: F401
    from checks.registry import ORACLES, QUERIES

    sf_dir = f"/root/testdata/sf{argv[0] if argv else '0.001'}"
    prefixes = tuple(argv[1:]) or ("",)
    spark = build_session("checks", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, fn in QUERIES.items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            result = difference(df, con, ORACLES[name]) if name in ORACLES else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        ok = result is None or result.startswith("rows only")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {result or ''}", flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
