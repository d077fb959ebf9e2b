"""Command line: run a place's programs, or the cross-place analysis.

    spark-submit parcelscope/cli.py place ohio --root hdfs:///zoning --out hdfs:///outputs/ohio
    spark-submit parcelscope/cli.py analysis --root hdfs:///zoning --out hdfs:///outputs/analysis

``place`` writes the place's result files (label reports, per-county counts
and histograms, census measures, quality records). ``analysis`` writes the
feature table of the chosen places (CSV with header) and the analysis
results (Parquet), one directory each.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parcelscope.plans import analysis, place_outputs, place_run, places  # noqa: E402
from parcelscope.session import get_session, remove_scratch  # noqa: E402
from parcelscope.sources import sinks  # noqa: E402


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="parcelscope")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("place", help="run one place's programs (E1-E8)")
    p.add_argument("name", choices=sorted(places.PLACES))
    p.add_argument("--root", required=True)
    p.add_argument("--out", required=True)
    a = sub.add_parser("analysis", help="feature table of places + analysis (J3, E9)")
    a.add_argument("--root", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--places", default=",".join(places.PLACES))
    a.add_argument("--no-zero-fill", action="store_true")
    args = ap.parse_args(argv)

    spark = get_session(app=f"parcelscope-{args.cmd}")
    if args.cmd == "place":
        paths = place_outputs.write_place_outputs(spark, args.root, places.PLACES[args.name], args.out)
        for name, path in sorted(paths.items()):
            print(f"{name}\t{path}")
    else:
        names = [n.strip() for n in args.places.split(",") if n.strip()]
        table = place_run.feature_table(spark, args.root, names, zero_fill=not args.no_zero_fill)
        out = args.out.rstrip("/")
        sinks.write_single_file(table, f"{out}/allStats", "csv", mode="overwrite")
        res = analysis.analyze(spark, spark.read.option("header", True)
                               .schema(table.schema).csv(f"{out}/allStats"),
                               place_run.KEY, places.FEATURE_COLUMNS, fit_to_rows=True)
        for name, df in res.items():
            df.write.mode("overwrite").parquet(f"{out}/{name}")
            print(f"{name}\t{out}/{name}")
    remove_scratch(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
