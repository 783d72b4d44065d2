"""Command line: read point lines, run one operator, write the result.

    spark-submit -m tessera ring INPUT OUTPUT [-k 5]
    python -m tessera exact INPUT OUTPUT

Run ``python -m tessera --help`` for all commands.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

import tessera as ts


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tessera", description=__doc__.splitlines()[0])
    parser.add_argument("--on-bad", choices=("fail", "drop", "keep"), default="fail")
    parser.add_argument("--id-type", default="bigint", help="SQL type of the point ids")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("input")
        sub.add_argument("output")
        return sub

    for name, text in (
        ("ring", "approximate kNN over rings, nested lists"),
        ("exact", "exact kNN, nested lists"),
        ("brute", "exact kNN, text report"),
    ):
        sub = command(name, text)
        sub.add_argument("-k", type=int, default=5)
        sub.add_argument("--ties", choices=("distinct", "all"), default="distinct")
        if name == "brute":
            sub.add_argument("--targets", help="lines to search, by default those of INPUT")
            sub.add_argument("--axes", choices=("plane", "x"), default="plane")
            sub.add_argument("--keep-self", action="store_true")
        else:
            if name == "exact":
                sub.add_argument("--targets", help="lines to search, by default those of INPUT")
            sub.add_argument("--format", choices=("parquet", "json", "orc", "text"), default="text")
        if name == "ring":
            sub.add_argument("--rings", type=int)
            sub.add_argument("--boundary", choices=("fraction", "relative"), default="fraction")
    radius = command("radius", "all pairs within a radius, Parquet")
    radius.add_argument("--radius", type=float, default=0.01)
    radius.add_argument("--cap", type=int, help="keep only the nearest CAP per source")
    grow = command("upsample", "grow the point set, point lines")
    grow.add_argument("--factor", type=int, default=5)
    grow.add_argument("--cells", type=int, default=100, help="grid cells per axis")
    grow.add_argument("--seed", type=int, default=42)
    return parser


def _last_lines(lines: DataFrame) -> DataFrame:
    """The last line per id, in file order."""
    return ts.dedup_last(lines.select("id", "x", "y", "pos"), "id", ["pos"])


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """One command; its intermediate tables are deleted at the end."""
    with ts.Tables() as tables:
        _run(spark, args)
    tables.release(spark)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = ts.read_points(
        spark, args.input, args.on_bad, args.id_type, with_position=args.command in ("radius", "upsample")
    )
    targets = None
    if getattr(args, "targets", None):
        targets = ts.read_points(spark, args.targets, args.on_bad, args.id_type)
    if args.command == "ring":
        found = ts.knn_ring(lines, args.k, args.rings, args.boundary, args.ties)
        ts.write_neighbours(found, args.output, args.format)
    elif args.command == "exact":
        found = ts.knn_exact(lines, targets, args.k, exclude_self=targets is None, ties=args.ties)
        ts.write_neighbours(found, args.output, args.format)
    elif args.command == "brute":
        found = ts.knn_brute(
            lines, targets, args.k, axes=args.axes, exclude_self=not args.keep_self, ties=args.ties
        )
        ts.write_report(found, args.output)
    elif args.command == "radius":
        sources = _last_lines(lines)
        if args.cap is None:
            found = ts.radius_join(sources, lines, args.radius)
        else:
            found = ts.radius_join_capped(sources, lines, args.radius, args.cap)
        found.write.parquet(args.output)
    else:
        # The grid spans all lines, the counts are of the last line per id.
        grown = ts.upsample(
            _last_lines(lines),
            args.factor,
            args.cells,
            args.cells,
            args.seed,
            box=ts.bounding_box(lines),
        )
        ts.write_points(grown, args.output)


def main() -> None:
    run(SparkSession.builder.appName("tessera").getOrCreate(), arguments().parse_args())


if __name__ == "__main__":
    main()
