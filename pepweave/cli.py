"""Command line: python -m pepweave run --config FILE --set key=value."""

from __future__ import annotations

import argparse

from .config import Config

VERSION = "0.1.0"


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="pepweave")
    parser.add_argument("--version", action="version", version=VERSION)
    run = parser.add_subparsers(dest="command", required=True).add_parser("run", help="run the stages that the configuration asks for")
    run.add_argument("--config", required=True)
    run.add_argument("--set", action="append", default=[], metavar="KEY=VALUE", dest="overrides")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    config = Config.from_yaml(args.config).with_overrides(args.overrides)
    config.to_yaml(f"{config.outdir}/config.yaml")
    from pyspark.sql import SparkSession

    from .plans.pipeline import Pipeline
    from .sources.sinks import log_to

    log_to(f"{config.outdir}/pepweave.log").info("starting")
    Pipeline(SparkSession.builder.appName("pepweave").getOrCreate(), config).run()
