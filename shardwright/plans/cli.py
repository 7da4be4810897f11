"""spark-submit entry points: `validate` and `sweep`."""

from __future__ import annotations

import argparse
import datetime
import json
import sys

from pyspark.sql import SparkSession

from ..sources.store import Store, canonical
from ..streaming.arrivals import pending
from .publish import promote
from .sweep import sweep
from .validate import validate


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="shardwright")
    kinds = parser.add_subparsers(dest="kind", required=True)
    one = kinds.add_parser("validate")
    one.add_argument("--landing", required=True)
    one.add_argument("--data", required=True)
    one.add_argument("--prefix", action="append")
    one.add_argument("--promote", action="store_true")
    one.add_argument("--promote-workers", type=int, default=16, help="files that are copied at a time")
    one.add_argument("--now", default=None)
    two = kinds.add_parser("sweep")
    two.add_argument("--data", required=True)
    two.add_argument("--json", action="store_true")
    two.add_argument("--contents", action="store_true")
    asked = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    data = Store(spark, asked.data)
    if asked.kind == "sweep":
        report = sweep(data, asked.contents)
        print(json.dumps(report.document(), indent=2) if asked.json else "\n".join(" ".join(map(str, f)) for f in report.findings) or "ok")
        return 0 if report.ok else 2
    landing, failed = Store(spark, asked.landing), False
    now = asked.now or datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")
    for prefix in asked.prefix or pending(landing):
        result = validate(landing, prefix, data)
        print(prefix, result.status)
        failed |= not result.ok
        if result.ok and asked.promote:
            promote(result, landing, data, now, asked.promote_workers)
        elif result.status == "rejected":
            landing.put(f"{prefix}/_REJECTED.json", canonical(result.document() | {"at": now}), replace=True)
    return int(failed)


if __name__ == "__main__":
    sys.exit(main())
