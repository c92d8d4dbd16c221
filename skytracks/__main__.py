"""Run the pipeline: ``spark-submit`` or ``python -m skytracks ROOT [options]``."""

from __future__ import annotations

import argparse
from datetime import timedelta

from skytracks.plans.pipeline import run
from skytracks.schemas import HORIZON_ROWS, BoundingBox
from skytracks.session import build_session


def main(arguments: list[str] | None = None) -> dict[str, str | None]:
    box = BoundingBox()
    parser = argparse.ArgumentParser(prog="skytracks")
    parser.add_argument("root", help="folder of the lake")
    parser.add_argument("--landing", help="folder of raw snapshot documents; without it bronze is taken as it is")
    parser.add_argument("--one-per-line", action="store_true", help="documents are lines, not files")
    parser.add_argument("--mode", choices=("full", "incremental"), default="incremental")
    parser.add_argument("--as-of", help="UTC time the lookback counts from, now if not given")
    parser.add_argument("--lookback-minutes", type=float, default=60)
    parser.add_argument("--train", action="store_true", help="fit the models before scoring")
    parser.add_argument("--no-predictions", action="store_true")
    parser.add_argument("--table", help="catalog table that receives gold as well")
    parser.add_argument("--connector", help="data source that receives gold as well, such as staged_loads")
    parser.add_argument("--connector-option", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--published", action="store_true", help="silver and gold are read by their manifests")
    parser.add_argument("--overlap-minutes", type=float, default=60)
    parser.add_argument("--on-malformed", choices=("fail", "skip"), default="fail")
    parser.add_argument("--horizon", type=int, default=HORIZON_ROWS, help="rows that a target lies ahead")
    parser.add_argument("--at-once", type=int, default=1, help="forests fitted side by side")
    for name in ("lamin", "lamax", "lomin", "lomax"):
        parser.add_argument(f"--{name}", type=float, default=getattr(box, name))
    options = parser.parse_args(arguments)
    done = run(
        build_session(),
        options.root,
        options.landing,
        options.mode,
        options.as_of,
        timedelta(minutes=options.lookback_minutes),
        BoundingBox(options.lamin, options.lamax, options.lomin, options.lomax),
        options.one_per_line,
        options.train,
        not options.no_predictions,
        options.table,
        timedelta(minutes=options.overlap_minutes),
        options.on_malformed,
        options.horizon,
        options.published,
        options.connector,
        dict(option.split("=", 1) for option in options.connector_option),
        {"at_once": options.at_once},
    )
    for stage, path in done.items():
        print(f"{stage}: {path or 'nothing to do'}")
    return done


if __name__ == "__main__":
    main()
