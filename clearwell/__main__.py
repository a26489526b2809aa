"""``python -m clearwell``, also under spark-submit: one batch over landed files."""

from __future__ import annotations

import argparse

from clearwell.plans.batch import Source, run_sources
from clearwell.session import build_session


def source(text: str) -> Source:
    """``table=format:path`` as a source."""
    table, _, rest = text.partition("=")
    fmt, _, path = rest.partition(":")
    if not (table and fmt and path):
        raise argparse.ArgumentTypeError(f"expected table=format:path, got {text!r}")
    return Source(path, fmt, table)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="clearwell", description="Check landed files and write them to the lake.")
    parser.add_argument("sources", nargs="+", type=source, metavar="table=format:path")
    parser.add_argument("--lake", required=True, help="folder of the tables")
    parser.add_argument("--batch", required=True, help="id of the batch; running it again replaces its rows")
    parser.add_argument("--mode", choices=("infer", "text"), default="infer", help="guess column types or read text")
    parser.add_argument("--per-file", action="store_true", help="remove duplicates within a file only")
    chosen = parser.parse_args(arguments)
    spark = build_session()
    summary = run_sources(spark, chosen.sources, chosen.lake, chosen.batch, chosen.mode, chosen.per_file)
    summary.show(len(chosen.sources), truncate=False)


if __name__ == "__main__":
    main()
