"""Run one registered question from the command line.

    python -m tillroll                      # list the question keys
    python -m tillroll q32 --sf /root/testdata/sf0.01 --rows 20 [--explain] [--master local[8]]
"""

from __future__ import annotations

import argparse


def main(argv: list[str] | None = None) -> None:
    from tillroll.plans.registry import DESCRIPTIONS, QUESTIONS, queries
    parser = argparse.ArgumentParser(prog="python -m tillroll")
    parser.add_argument("key", nargs="?", help="question key (omit to list them)")
    parser.add_argument("--sf", default="/root/testdata/sf0.01", help="folder of the parquet tables")
    parser.add_argument("--rows", type=int, default=20)
    parser.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    parser.add_argument("--master", default="local[*]")
    args = parser.parse_args(argv)
    if not args.key:
        for key in QUESTIONS:
            print(f"{key:16s} {DESCRIPTIONS.get(key, '')}")
        return
    from tillroll.session import build_session
    spark = build_session(args.master, 8, "tillroll-cli")
    df = queries()[args.key](spark, args.sf)
    if args.explain:
        df.explain("formatted")
    df.show(args.rows, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
