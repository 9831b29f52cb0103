"""Command line: list the sheets of a workbook, or extract its tables."""

from __future__ import annotations

import argparse
import sys

from .config import Settings
from .selection import SelectionError
from .sources.ooxml import WorkbookError


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gridloom", description="Extract the tables of workbooks.")
    p.add_argument("workbook")
    p.add_argument("--list-sheets", action="store_true")
    p.add_argument("--sheet", action="append", default=[])
    p.add_argument("--sheet-glob", action="append", default=[])
    p.add_argument("--sheet-index", default="")
    many = p.add_mutually_exclusive_group()
    many.add_argument("--all-sheets", action="store_true")
    many.add_argument("--visible-sheets", action="store_true")
    p.add_argument("--output")
    p.add_argument("--table-threshold", type=float, default=0.50)
    p.add_argument("--uncertain-threshold", type=float, default=0.35)
    p.add_argument("--no-cached-values", action="store_true")
    p.add_argument("--max-file-mb", type=int, default=300)
    p.add_argument("--max-material-cells", type=int, default=1_500_000)
    p.add_argument("--debug", action="store_true")
    return p


def catalog_text(rows) -> str:
    return "\n".join(f"{r['position']:>3}  {r['state']:<10}  {r['n_cells']:>8} cells  {r['sheet']}" for r in rows)


def main(argv: list[str] | None = None, spark=None) -> int:
    """0: done; 2: wrong input; 130: interrupted."""
    args = parser().parse_args(argv)
    try:
        settings = Settings(table_score_threshold=args.table_threshold, uncertain_table_threshold=args.uncertain_threshold, include_cached_values=not args.no_cached_values, max_file_bytes=args.max_file_mb << 20, max_material_cells_per_sheet=args.max_material_cells)
        from pyspark.sql import SparkSession

        from .api import extract, write_bundle
        from .plans.export import default_output
        from .sources import ooxml

        spark = spark or SparkSession.builder.appName("gridloom").getOrCreate()
        rows = ooxml.read_sheets(spark, args.workbook, settings).orderBy("position").collect()
        if args.list_sheets:
            print(catalog_text(rows))
            return 0
        picked = args.sheet or args.sheet_glob or args.sheet_index or args.all_sheets or args.visible_sheets
        if not picked:
            if not sys.stdin.isatty():
                raise SelectionError("name the sheets to read, for example with --visible-sheets")
            print(catalog_text(rows))
            args.sheet_index = input("Sheets (for example 1,3-4): ")
        run = extract(spark, args.workbook, args.sheet or None, settings, globs=args.sheet_glob, indexes=args.sheet_index, every=args.all_sheets, visible=args.visible_sheets)
        print(write_bundle(spark, run, args.output or default_output(args.workbook), settings))
        return 0
    except KeyboardInterrupt:
        return 130
    except (SelectionError, WorkbookError, FileExistsError, FileNotFoundError, ValueError) as e:
        if args.debug:
            raise
        print(f"error: {e}", file=sys.stderr)
        return 2
    except Exception as e:
        cause = next((x for x in ("PackageSecurityError", "WorkbookError", "PATH_NOT_FOUND") if x in str(e)), None)
        if args.debug or not cause:
            raise
        line = next((x for x in str(e).splitlines() if cause in x), cause)
        print(f"error: {line.strip()[:300]}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
