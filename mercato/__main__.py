"""Command-line jobs: ``python -m mercato <command> ...``.

Commands: ``land`` (raw files -> bronze parquet, batch or incremental), ``compact`` (landed loads -> large files),
``quality`` (contract violations in the raw files), ``silver``, ``gold``, ``init-serving`` (typed serving tables), ``serve``
(load gold into serving tables), ``counts`` (row count per serving table).
Connection options for JDBC are passed by the caller (``--jdbc key=value``).
"""

from __future__ import annotations

import argparse
import sys

from mercato.contracts import SERVING_DDL
from mercato.plans.gold import GOLD_TABLES


def _options(pairs: list[str] | None) -> dict[str, str] | None:
    if not pairs:
        return None
    out = {}
    for p in pairs:
        key, _, value = p.partition("=")
        out[key] = value
    return out


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="python -m mercato")
    sub = ap.add_subparsers(dest="command", required=True)

    land = sub.add_parser("land", help="raw CSV files -> bronze parquet")
    land.add_argument("--src", required=True, help="file or folder of raw CSV files")
    land.add_argument("--bronze", required=True)
    land.add_argument("--entity", required=True)
    land.add_argument("--incremental", action="store_true", help="land only files not landed before")
    land.add_argument("--checkpoint", help="lasting checkpoint folder of --incremental (default: below spark.checkpoint.dir)")

    land.add_argument("--rejects", help="folder for files and rows that cannot land (default: they fail the run)")

    compact = sub.add_parser("compact", help="landed loads of an entity -> a few large files")
    compact.add_argument("--bronze", required=True)
    compact.add_argument("--entity", required=True)
    compact.add_argument("--target-bytes", type=int, default=128 << 20)

    silver = sub.add_parser("silver", help="bronze CSV -> silver parquet")
    silver.add_argument("--bronze", required=True)
    silver.add_argument("--silver", required=True)
    silver.add_argument("--entities", nargs="*")
    silver.add_argument("--on-missing", choices=["skip", "error"], default="skip")
    silver.add_argument("--from-landed", action="store_true", help="read landed bronze parquet instead of raw CSV")

    silver.add_argument("--update", action="store_true", help="take in only landed loads that silver does not hold yet")

    gold = sub.add_parser("gold", help="silver parquet -> gold parquet")
    gold.add_argument("--silver", required=True)
    gold.add_argument("--gold", required=True)
    gold.add_argument("--tables", nargs="*", choices=GOLD_TABLES)
    gold.add_argument("--how", choices=["left", "inner"], default="left")
    gold.add_argument("--bucket", action="append", metavar="TABLE=KEY",
                      help="write TABLE as a catalog table bucketed on KEY (repeatable)")
    gold.add_argument("--buckets", type=int, default=0, help="bucket count for --bucket tables")
    gold.add_argument("--table-prefix", default="", help="catalog name prefix for bucketed tables")

    gold.add_argument("--publish", action="store_true", help="write versions and let them count in one step")

    init = sub.add_parser("init-serving", help="create typed serving tables if absent")
    init.add_argument("--tables", nargs="*", choices=sorted(SERVING_DDL))

    serve = sub.add_parser("serve", help="load written gold tables into serving tables")
    serve.add_argument("--gold", required=True)
    serve.add_argument("--tables", nargs="*", choices=GOLD_TABLES)
    serve.add_argument("--mode", choices=["replace", "truncate", "publish"], default="replace")
    serve.add_argument("--jdbc", action="append", metavar="KEY=VALUE", help="JDBC writer option (repeatable)")

    dq = sub.add_parser("quality", help="contract violations per raw entity (before typing)")
    dq.add_argument("--bronze", required=True)
    dq.add_argument("--entities", nargs="*")

    counts = sub.add_parser("counts", help="row count per serving table")
    counts.add_argument("--tables", nargs="*", default=list(GOLD_TABLES))
    return ap


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from mercato.session import build_session

    spark = build_session(app_name=f"mercato-{args.command}")
    if args.command == "land":
        if args.incremental:
            from mercato.streaming.landing import land_available

            land_available(
                spark, args.src, args.bronze, args.entity, checkpoint_root=args.checkpoint, rejects_root=args.rejects
            )
        else:
            from mercato.sources.bronze import land_raw

            land_raw(spark, args.src, args.bronze, args.entity, rejects_root=args.rejects)
    elif args.command == "compact":
        from mercato.sources.bronze import compact_landed

        for load in compact_landed(spark, args.bronze, args.entity, args.target_bytes):
            print(f"{load}: compacted")
    elif args.command == "silver" and args.update:
        from mercato.plans.silver import update_silver

        for name, loads in update_silver(spark, args.bronze, args.silver, args.entities).items():
            print(f"{name}: {len(loads)} loads")
    elif args.command == "silver":
        from mercato.plans.silver import build_silver

        source = "landed" if args.from_landed else "csv"
        written = build_silver(spark, args.bronze, args.silver, args.entities, args.on_missing, source=source)
        for name, path in written.items():
            print(f"{name}: {path}")
    elif args.command == "gold":
        from mercato.plans.jobs import build_gold

        written = build_gold(
            spark, args.silver, args.gold, args.tables, how=args.how,
            bucket_by=_options(args.bucket), buckets=args.buckets, table_prefix=args.table_prefix, publish=args.publish,
        )
        for name, path in written.items():
            print(f"{name}: {path}")
    elif args.command == "init-serving":
        from mercato.sources.serving import ensure_table

        for name in args.tables or sorted(SERVING_DDL):
            ensure_table(spark, name, SERVING_DDL[name])
            print(f"{name}: ready")
    elif args.command == "serve":
        from mercato.plans.jobs import load_serving

        for name in load_serving(spark, args.gold, args.tables, mode=args.mode, jdbc_options=_options(args.jdbc)):
            print(f"{name}: loaded")
    elif args.command == "quality":
        from mercato.plans.quality import bronze_quality_report

        report = bronze_quality_report(spark, args.bronze, args.entities)
        for row in report.filter("violations > 0").orderBy("entity", "column_name", "rule").collect():  # small report
            print(f"{row.entity}.{row.column_name} {row.rule}: {row.violations:,}")
    elif args.command == "counts":
        from mercato.plans.quality import table_counts

        present = {t: spark.table(t) for t in args.tables if spark.catalog.tableExists(t)}
        if present:
            for row in table_counts(present).collect():  # one row per table
                print(f"{row.table_name}: {row.row_count:,}")
        for t in args.tables:
            if t not in present:
                print(f"{t}: missing")
    return 0


if __name__ == "__main__":
    sys.exit(main())
