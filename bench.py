"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query is built and run to the end once to warm up, then ``BENCH_RUNS``
times; the best run counts. The build is part of the time. A table given as one
row group is one split, however large it is and however many cores there are, so
the larger tables are first stored anew in one file a core, outside the times.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from tributary.plans.queries import QUERIES  # noqa: E402
from tributary.session import local_session  # noqa: E402

HEADLINE = [
    "revenue_monthly",
    "sales_wide",
    "normalize_shopify",
    "normalize_mercadolibre",
    "normalize_amazon",
    "normalize_tiendanube",
    "normalize_pos",
    "dedupe_keep_last",
    "line_positions",
    "fx_attach",
    "canonical_sku",
    "unmapped_sku_report",
    "validation_summary",
    "rejected_lines",
    "fact_upsert",
]


SPREAD = ["lineitem", "orders", "events", "customer"]


def spread(spark: SparkSession, sf_dir: str, cores: int) -> str:
    """A folder with the same tables, the larger ones in ``cores`` files."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for path in Path(sf_dir).glob("*.parquet"):
        if path.stem in SPREAD:
            spark.read.parquet(str(path)).repartition(cores).write.parquet(f"{folder}/{path.name}")
        else:
            Path(folder, path.name).symlink_to(path)
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session("bench", cpus, int(cpus))
    given, sf_dir = sf_dir, spread(spark, sf_dir, int(cpus))
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(1 + runs):
            start = time.monotonic()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.monotonic() - start)
        times[name] = round(min(taken[1:]), 3)
        print(f"{name}: first {taken[0]:.2f}s, then {times[name]:.2f}s", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of warm runs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(given).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
