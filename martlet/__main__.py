"""Build the whole model from landing CSVs, in the reference's run order:
raw load -> staging -> dimensions and facts -> dashboard extracts (CSV)
-> validation report.

    python -m martlet --landing DIR --lake DIR [--extracts DIR]
                      [--scope-lo YYYY-MM-DD --scope-hi YYYY-MM-DD]
                      [--status delivered --status shipped] [--patch PT=EN ...]
                      [--lenient [--max-rejects N]] [--expect TABLE=ROWS ...] [--publish PREFIX]

Paths should be on shared storage on a cluster. Every table is written as
the next version (see ``sources.versions``), so a build that fails leaves
the last one readable. The report is printed and the exit status is 1 when
any check fails.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from dataclasses import replace

from .plans.checks import expected_figures_report, validation_report
from .plans.model import Model
from .plans.scope import (REFERENCE_EXPECTED_REVENUE_NET, REFERENCE_EXPECTED_ROWS, REFERENCE_STATUSES,
                          REFERENCE_TRANSLATION_PATCHES, ModelParams, Scope)
from .session import build_session, tune_for_input
from .sources.catalog import publish
from .sources.csv import load_raw_layer, load_report, loaded_rows
from .sources.schemas import RAW_FILES


def params_from(args) -> ModelParams:
    base = ModelParams()
    scope = Scope(tuple(args.status or REFERENCE_STATUSES),
                  dt.date.fromisoformat(args.scope_lo) if args.scope_lo else base.scope.lo,
                  dt.date.fromisoformat(args.scope_hi) if args.scope_hi else base.scope.hi)
    patches = (tuple(tuple(p.split("=", 1)) for p in args.patch) if args.patch is not None
               else REFERENCE_TRANSLATION_PATCHES)
    spine = None if args.spine_from_data else base.spine
    return ModelParams(scope=scope, spine=spine, translation_patches=patches,
                       lenient_casts=bool(getattr(args, "lenient", False)))


def folder_bytes(spark, path: str) -> int:
    """Size of a file or folder on whatever storage Spark reads it from."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def build(spark, landing: str, lake: str, extracts: str | None, params: ModelParams,
          date_partitioned: bool = False, bucketed_schema: str | None = None, buckets: int | None = None,
          files: dict[str, str] | None = None, expected: dict[str, int] | None = None, publish_as: str | None = None):
    """Raw load to validation report. With ``params.lenient_casts`` malformed
    rows are set aside by the load (``load_report`` counts them), so staging
    types the rest strictly."""
    tune_for_input(spark, folder_bytes(spark, landing))
    root = lake.rstrip("/")
    raw = load_raw_layer(spark, landing, out=root, files=files, quarantine=params.lenient_casts)
    params = replace(params, lenient_casts=False)
    model = Model(spark, raw, params, loaded_rows=loaded_rows(spark, root), lake=root)
    if bucketed_schema:
        marts = model.materialize_bucketed(bucketed_schema, buckets, f"{root}/{bucketed_schema}")
    else:
        marts = model.materialize(f"{root}/marts", date_partitioned=date_partitioned)
    if extracts:
        marts.write_extracts(extracts)
    if publish_as is not None:
        publish(spark, root, publish_as, params.lenient_casts, params.translation_patches)
    return marts, validation_report(marts, expected=expected)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="python -m martlet", description=(
        "Build the model from landing CSVs: raw load, staging, dimensions and facts, "
        "dashboard extracts, validation report."))
    ap.add_argument("--landing", required=True, help="folder with the nine source CSVs")
    ap.add_argument("--lake", required=True, help="output root: raw/ and marts/ are written here")
    ap.add_argument("--extracts", help="folder for the three dashboard extracts (CSV)")
    ap.add_argument("--scope-lo", help="first purchase date in scope (YYYY-MM-DD)")
    ap.add_argument("--scope-hi", help="first purchase date after the scope (exclusive)")
    ap.add_argument("--status", action="append", help="order status in scope (repeatable)")
    ap.add_argument("--patch", action="append", help="translation patch PT=EN (repeatable)")
    ap.add_argument("--spine-from-data", action="store_true",
                    help="date spine over whole years of the purchase dates instead of fixed bounds")
    ap.add_argument("--date-partitioned", action="store_true",
                    help="write the facts with one folder per date_key (partition pruning)")
    ap.add_argument("--bucketed-schema", help="write the marts as catalog tables in this schema, facts and "
                    "dim_customer bucketed on customer_id (co-located joins)")
    ap.add_argument("--buckets", type=int, help="bucket count for --bucketed-schema (default: from the measured input size)")
    ap.add_argument("--lenient", action="store_true",
                    help="set malformed rows aside and count them instead of failing the load")
    ap.add_argument("--max-rejects", type=int, metavar="N", help="with --lenient: fail when more rows than this are set aside")
    ap.add_argument("--expect", action="append", metavar="TABLE=ROWS", help="documented rows of a raw table (repeatable)")
    ap.add_argument("--publish", metavar="PREFIX", nargs="?", const="", help="name the layers in the catalog: schemas PREFIXraw, "
                    "PREFIXstaging (views) and PREFIXmarts")
    ap.add_argument("--reference-expected", action="store_true",
                    help="also compare row counts and revenue with the figures stated for the original dataset")
    ap.add_argument("--file", action="append", metavar="TABLE=NAME", help="file, folder or glob of a table below "
                    "--landing where it is not TABLE.csv (repeatable)")
    args = ap.parse_args(argv)
    files = dict(RAW_FILES, **dict(f.split("=", 1) for f in args.file or ()))
    spark = build_session(app_name="martlet-build")
    expected = {k: int(v) for k, v in (e.split("=", 1) for e in args.expect)} if args.expect else None
    marts, report = build(spark, args.landing, args.lake, args.extracts, params_from(args),
                          args.date_partitioned, args.bucketed_schema, args.buckets, files, expected, args.publish)
    set_aside = 0
    if args.lenient:
        for r in load_report(spark, args.lake).where("reason IS NOT NULL").orderBy("table_name", "file", "reason").collect():
            print(f"{r.table_name:26s} {r.rows:10d} {r.reason}  {r.file}")
            set_aside += r.rows
    rows = report.collect()
    for r in rows:
        print(f"{r.check:32s} {'pass' if r.passed else 'FAIL'}")
    ok = all(r.passed for r in rows) and (args.max_rejects is None or set_aside <= args.max_rejects)
    if args.reference_expected:
        for r in expected_figures_report(marts, REFERENCE_EXPECTED_ROWS, REFERENCE_EXPECTED_REVENUE_NET).collect():
            print(f"{r.item:36s} {r.actual:>14s} expected {r.expected:>14s} {'pass' if r.passed else 'FAIL'}")
            ok = ok and bool(r.passed)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
