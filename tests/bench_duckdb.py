"""Time the oracle SQL in DuckDB on the same test tables (single node),
for comparison with the Spark queries from the raw tables."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.compare import connect  # noqa: E402
from tidewatch.oracle import SQL  # noqa: E402


def main(sf_dir: str, names: list[str], repeat: int = 3) -> None:
    con = connect(sf_dir)
    out = {}
    for name in names or sorted(SQL):
        runs = []
        for _ in range(repeat):
            t = time.perf_counter()
            con.sql(SQL[name]).fetchall()
            runs.append(time.perf_counter() - t)
        out[name] = round(statistics.median(runs), 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
