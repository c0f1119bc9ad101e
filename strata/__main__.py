"""Command line: run pipeline layers.

    python -m strata --landing <dir> --lake <dir> [--layers bronze,silver,gold,kpi]
                     [--tables orders,order_items] [--as-of 2024-01-31] [--format parquet]
                     [--stream]

Intended for spark-submit / a scheduler task per layer; the session comes
from the cluster (``getOrCreate``), library defaults fill only unset settings.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from strata.plans.pipeline import PipelineConfig, run
from strata.session import build_session

LAYERS = ("bronze", "silver", "gold", "kpi")


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="strata", description=__doc__.splitlines()[0])
    p.add_argument("--landing", required=True, help="landing folder (<table>.csv per table)")
    p.add_argument("--lake", required=True, help="root folder of the layered tables")
    p.add_argument("--layers", default=",".join(LAYERS))
    p.add_argument("--tables", default="", help="registry tables for bronze/silver (default all)")
    p.add_argument("--as-of", default=None, help="date for the open-order columns")
    p.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    p.add_argument("--collapse", default="first", choices=["first", "all"])
    p.add_argument("--stream", action="store_true",
                   help="load landing/<table>/ folders with an availableNow stream instead")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> dict:
    a = parse(sys.argv[1:] if argv is None else argv)
    layers = tuple(x for x in a.layers.split(",") if x)
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise SystemExit(f"unknown layers: {sorted(unknown)}")
    spark = build_session()
    tables = [t for t in a.tables.split(",") if t] or None
    if a.stream:
        from strata.streaming import stream_tables
        stream_tables(spark, a.landing, a.lake, tables=tables, collapse=a.collapse)
        layers = tuple(x for x in layers if x not in ("bronze", "silver"))
    cfg = PipelineConfig(landing_dir=a.landing, lake_root=a.lake, tables=tables,
                         as_of=dt.date.fromisoformat(a.as_of) if a.as_of else None,
                         collapse=a.collapse, table_format=a.format)
    report = run(spark, cfg, layers) if layers else {}
    print(json.dumps(report, default=str))
    return report


if __name__ == "__main__":
    main()
