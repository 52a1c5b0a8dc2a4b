"""Run every registered query against its oracle: ``python tests/check_all.py [folder] [name part ...]``."""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import connect, differences  # noqa: E402

from millrace.queries import ORACLES, QUERIES  # noqa: E402
from millrace.session import local_session  # noqa: E402


def main(folder: str, parts: list[str]) -> int:
    spark, con, bad = local_session(8), connect(folder), 0
    for name, build in QUERIES.items():
        if parts and not any(part in name for part in parts):
            continue
        started = time.time()
        try:
            df = build(spark, folder)
            if name in ORACLES:
                found = differences(df, con, ORACLES[name])
                count = ""
            else:
                found, count = [], f"{df.count()} rows, no oracle"
        except Exception as error:  # report and go on with the next query
            found, count = [f"{type(error).__name__}: {str(error)[:700]}", traceback.format_exc()[-300:]], ""
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name:32s} {time.time() - started:6.2f}s {count}", flush=True)
        for line in found:
            print("     ", line, flush=True)
    print(f"{bad} failing of {len(QUERIES)}, {len(ORACLES)} with oracle")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.001"
    sys.exit(main(folder, [a for a in args if not a.startswith("/")]) > 0)
