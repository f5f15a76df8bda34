"""Job for spark-submit: ``job.py run --source ... --raw ... --trusted ... --delivery ... --logs ...``."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from probelake import fixed
from probelake.plans.config import GEN_1, GEN_2, LakeConfig, small_landing
from probelake.plans.delivery import build_delivery
from probelake.plans.flow import run
from probelake.plans.ingest import ingest
from probelake.plans.trusted import build_trusted
from probelake.session import build_session

STAGES: dict[str, Callable[[SparkSession, LakeConfig], object]] = {
    "ingest": ingest,
    "trusted": build_trusted,
    "delivery": build_delivery,
    "run": run,
}


def parse(arguments: Sequence[str] | None = None) -> tuple[str, LakeConfig]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("stage", choices=STAGES)
    for folder in ("source", "raw", "trusted", "delivery", "logs"):
        parser.add_argument(f"--{folder}", default="")
    parser.add_argument("--generation", choices=("1", "2"), default="2")
    parser.add_argument("--schema")
    parser.add_argument("--schema-location")
    parser.add_argument("--prefix", action="append", dest="prefixes", help="source key prefix; repeatable")
    parser.add_argument("--source-date-index", type=int, default=0)
    parser.add_argument("--min-mib", type=float, default=fixed.MIN_FILE_MIB)
    parser.add_argument("--limit-mib", type=float, default=fixed.COUNTRY_LIMIT_MIB)
    parser.add_argument("--small", action="store_true", help="small budget, date first in the key")
    parser.add_argument("--test-type", default=fixed.TEST_TYPE)
    parser.add_argument("--country", action="append", dest="landing_countries", help="repeatable")
    parser.add_argument("--null-keys", choices=("collapse", "keep"), default="collapse")
    parser.add_argument("--substring-match", action="store_true")
    options = vars(parser.parse_args(arguments))
    stage = options.pop("stage")
    needed = {
        "ingest": ("source", "raw"),
        "trusted": ("raw", "trusted", "logs"),
        "delivery": ("trusted", "delivery"),
        "run": ("source", "raw", "trusted", "delivery", "logs"),
    }[stage]
    missing = [f"--{name}" for name in needed if not options[name]]
    if missing:
        parser.error(f"{stage} needs {' '.join(missing)}")
    options["generation"] = GEN_1 if options["generation"] == "1" else GEN_2
    options["prefixes"] = options["prefixes"] or ("",)
    options["landing_countries"] = options["landing_countries"] or fixed.LANDING_COUNTRIES
    small = options.pop("small")
    cfg = LakeConfig(**options)
    return stage, small_landing(cfg) if small else cfg


def main(arguments: Sequence[str] | None = None) -> None:
    stage, cfg = parse(arguments)
    spark = build_session(f"measurement lake: {stage}")
    STAGES[stage](spark, cfg)


if __name__ == "__main__":
    main()
