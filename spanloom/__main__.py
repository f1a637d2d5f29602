"""Command line: ``python -m spanloom convert|validate|dialect|query ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from . import registry
from .functions.xmlcalls import DIALECTS
from .operators import dialects, quality
from .plans import convert
from .session import session
from .sources import files, sinks


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="spanloom")
    sub = p.add_subparsers(dest="what", required=True)
    c = sub.add_parser("convert", help="spans (JSON lines) to training rows")
    c.add_argument("spans")
    c.add_argument("out")
    c.add_argument("--variant", choices=["xml", "json"], default="xml")
    c.add_argument("--framework", default="")
    v = sub.add_parser("validate", help="keep the records whose assistant messages hold valid XML")
    v.add_argument("records")
    v.add_argument("out")
    v.add_argument("--mode", choices=["full", "tools"], default="full")
    d = sub.add_parser("dialect", help="rewrite the string leaves of JSON records")
    d.add_argument("records")
    d.add_argument("out")
    d.add_argument("--format", choices=DIALECTS, required=True)
    q = sub.add_parser("query", help="run a registered query")
    q.add_argument("name", choices=sorted(registry.queries()))
    q.add_argument("tables")
    args = p.parse_args(argv)
    spark = session()
    if args.what == "convert":
        rows = convert.convert(files.spans(spark, args.spans), args.framework, variant=args.variant)
        sinks.write_text(convert.training_lines(rows), "line", args.out)
    elif args.what == "validate":
        checked = quality.filter_valid(files.json_lines(spark, args.records).select(F.col("_raw").alias("line")), mode=args.mode)
        sinks.valid_only(checked, args.out)
    elif args.what == "dialect":
        lines = files.json_lines(spark, args.records).filter("ok").select(dialects.leaf_rewriter(args.format)(F.col("_raw")).alias("line"))
        sinks.write_text(lines, "line", args.out)
    else:
        registry.queries()[args.name](spark, args.tables).show(truncate=False)


if __name__ == "__main__":
    main()
