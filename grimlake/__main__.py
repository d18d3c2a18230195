"""Command line:

    spark-submit --py-files grimlake.zip grimlake/__main__.py run \
        --raw s3a://bucket/raw --work s3a://bucket/work --target prod
    python -m grimlake run --raw ... --work ...        (master from the environment)

``run`` lands the raw CSV folders, builds every model and runs the declared
checks (a failed check fails the job only for ``--target prod``). It prints
one line per failed check.
"""

from __future__ import annotations

import argparse
import sys

from grimlake.operators.quality import QualityError
from grimlake.plans import jobs
from grimlake.session import build_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="grimlake")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="load -> build -> check")
    run.add_argument("--raw", required=True, help="folder with bands/, albums/, reviews/ CSV")
    run.add_argument("--work", required=True, help="output folder (raw copy, models, failures)")
    run.add_argument("--target", default="dev", choices=["dev", "prod"])
    run.add_argument("--versioned", action="store_true", help="replace the build in --work as a whole")
    args = parser.parse_args(argv)
    spark = build_session()
    try:
        step = jobs.replace if args.versioned else jobs.run
        summary = step(spark, args.raw, args.work, target=args.target)
    except QualityError as exc:
        print(f"failed checks: {exc}", file=sys.stderr)
        return 1
    for row in summary:
        if row["failures"]:
            print(f"{row['severity']}: {row['check_id']} failures={row['failures']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
