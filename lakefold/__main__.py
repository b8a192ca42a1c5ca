"""Command line: ``python -m lakefold refresh SF_DIR`` (or ``--files FOLDER``) runs the
full refresh and prints the audit; ``python -m lakefold view WAREHOUSE NAME [--limit N]``
prints up to N rows of a gold view of a refreshed warehouse as JSON lines."""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lakefold")
    sub = parser.add_subparsers(dest="command", required=True)
    ref = sub.add_parser("refresh", help="land bronze, build silver, publish gold and quality views")
    ref.add_argument("sf_dir", nargs="?", help="folder of driver tables")
    ref.add_argument("--files", default=None, help="folder of source files to refresh from instead")
    ref.add_argument("--warehouse", default=None, help="target folder (default: under spark.checkpoint.dir)")
    view = sub.add_parser("view", help="read a gold view")
    view.add_argument("warehouse", help="folder of a refreshed warehouse")
    view.add_argument("name")
    view.add_argument("--limit", type=int, default=100)
    sub.add_parser("views", help="list the gold views")
    parser.add_argument("--master", default="local[*]")
    args = parser.parse_args(argv)

    from lakefold.plans.layers import Layers
    if args.command == "views":
        from lakefold.plans.serving import list_views
        print("\n".join(list_views(Layers.GOLD_VIEWS)))
        return 0

    from lakefold.session import build_session
    spark = build_session(args.master)
    try:
        if args.command == "refresh":
            from lakefold.plans.refresh import refresh_all
            if not args.sf_dir and not args.files:
                parser.error("refresh needs SF_DIR or --files FOLDER")
            wh = refresh_all(spark, args.sf_dir, args.warehouse, files=args.files)
            for r in wh.audit.orderBy("seq").collect():
                print(f"{r.seq:>3} {r.operation:<20} {r.table_id:<24} {r.status:<8} {r.n_rows if r.n_rows is not None else ''}")
            print(f"warehouse: {wh.root}")
            return 0 if wh.views else 1
        from lakefold.plans.refresh import open_warehouse
        from lakefold.plans.serving import ViewNotFound, read_view, rows_as_json
        wh = open_warehouse(spark, args.warehouse)
        views = {n: (lambda n=n: wh.views[n]) for n in Layers.GOLD_VIEWS if n in wh.views}
        try:
            rows = read_view(views, args.name, args.limit)
        except (ValueError, ViewNotFound) as exc:
            print(f"error: {exc}", file=sys.stderr)
            return 2
        for r in rows_as_json(rows).collect():   # at most 1000 rows, by the limit's contract
            print(r.json)
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
