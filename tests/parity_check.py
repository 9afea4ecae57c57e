"""Runs queries beside their SQL and compares rows as the check tool does: by name, in any order."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, Decimal):
        return value.normalize()
    return value


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, case, sf_dir: str) -> str | None:
    """None when both agree, else what differs."""
    df = case.build(spark, sf_dir)
    rows = df.collect()
    if case.sql is None:
        return None if rows else "no rows"
    cursor = con.execute(case.sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    got, want = _bag(df.columns, rows), _bag(names, expected)
    if got == want:
        return None
    extra, lacking = list((got - want).items())[:2], list((want - got).items())[:2]
    return f"{len(rows)} against {len(expected)} rows; only here {extra}; only there {lacking}"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from pactloom.parity import CASES
    from pactloom.session import build_session

    sf, wanted = sys.argv[1], sys.argv[2:]
    session = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(sf)
    failed = 0
    for name, case in CASES.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(session, duck, case, sf)
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
