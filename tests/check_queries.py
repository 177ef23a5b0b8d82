"""Command line: check registered queries against their SQL. Arguments: folder, then name parts."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from pixelspark.session import local_session  # noqa: E402
from tests.compare import compare, connect  # noqa: E402


def main(d: str, parts: list[str]) -> int:
    spark, con = local_session(), connect(d)
    queries, texts = entry.queries(), entry.oracle_sql()
    failed = []
    for name, fn in queries.items():
        if parts and not any(p in name for p in parts):
            continue
        try:
            ok, msg, n, a, b = compare(spark, con, d, fn, texts.get(name))
        except Exception as e:  # noqa: BLE001 - report and go on
            ok, msg, n, a, b = False, f"{type(e).__name__}: {str(e)[:900]}", 0, 0, 0
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} rows={n:<8d} spark={a:6.2f}s sql={b:6.2f}s {msg}", flush=True)
    print("failed:", failed)
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
