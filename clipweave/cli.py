"""Run a named query over a corpus folder and write or show its result, or the steps of a stage into a work folder."""

from __future__ import annotations

import argparse

from clipweave import steps
from clipweave.plans import registry
from clipweave.session import build_session


def main(argv: list[str] | None = None) -> int:
    """Entry of `python -m clipweave.cli`."""
    parser = argparse.ArgumentParser(prog="clipweave")
    parser.add_argument("query", nargs="?", help="a query; without one all names are listed")
    parser.add_argument("folder", nargs="?", help="corpus folder of Parquet tables")
    parser.add_argument("--out", help="write Parquet here instead of showing the first rows")
    parser.add_argument("--master", help="Spark master, if not set elsewhere")
    parser.add_argument("--stage", help="run the steps of a stage; the first argument is then the corpus folder, the second the work folder")
    parser.add_argument("--steps", help="run these steps, parted by commas, in place of a stage's")
    parser.add_argument("--from", dest="first", help="the first step to run")
    parser.add_argument("--to", dest="last", help="the last step to run")
    parser.add_argument("--limit", type=int, help="rows a step writes, for trials")
    parser.add_argument("--force", action="store_true", help="run steps that are done, too")
    args = parser.parse_args(argv)
    if args.stage or args.steps:
        if not (args.query and args.folder):
            parser.error("a corpus folder and a work folder are needed")
        names = steps.chosen(args.stage, only=args.steps.split(",") if args.steps else None, first=args.first, last=args.last)
        print(*steps.run(build_session("clipweave", args.master), args.query, args.folder, names, limit=args.limit, force=args.force))
        return 0
    queries = registry.queries()
    if not args.query:
        for name, f in sorted(queries.items()):
            print(f"{name}: {(f.__doc__ or '').strip()}")
        return 0
    if args.query not in queries or not args.folder:
        parser.error(f"no query {args.query!r}" if args.query not in queries else "a folder is needed")
    df = queries[args.query](build_session("clipweave", args.master), args.folder)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(20, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
