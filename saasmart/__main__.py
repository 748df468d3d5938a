"""Command line: the pipeline steps as one Spark application each.

    spark-submit -m saasmart run --root s3a://bucket/saas --batches 10
    python -m saasmart generate --root R --batches 2 [--seeds 7 11]
    python -m saasmart ingest   --root R
    python -m saasmart build    --root R [--marts gold ...] [--select dim_users ...]
    python -m saasmart audit    --root R
    python -m saasmart bootstrap --root R   (seed-0 tables straight into raw)

The session comes from the deployment (``getOrCreate``); ``--root`` is any
Hadoop filesystem URI and defaults to a fixed folder under the cluster's
``spark.checkpoint.dir``, the same for every step. Without ``--seeds`` each batch draws a random seed
(printed, so a run can be reproduced).
"""

from __future__ import annotations

import argparse
import json
import random
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from saasmart import schemas
from saasmart.plans import audit
from saasmart.plans import catalog as C
from saasmart.plans import runner as PL
from saasmart.session import shared_root
from saasmart.sources import landing as L
from saasmart.streaming import ingest as I


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="saasmart")
    p.add_argument("step", choices=["generate", "ingest", "build", "run", "audit", "bootstrap"])
    p.add_argument("--root", help="lake root (landing/, raw/, ledger/, warehouse/ below it)")
    p.add_argument("--batches", type=int, default=1, help="activity batches to generate")
    p.add_argument("--seeds", type=int, nargs="*", help="one seed per batch")
    p.add_argument("--users", type=int, default=None, help="number of users (default 2000)")
    p.add_argument("--select", nargs="*", help="models to build, with what they need (default: all)")
    p.add_argument("--buckets", type=int, default=0,
                   help="keep users, invoices and tickets of a new lake in so many buckets by user")
    for layer in ("raw", "staging", "intermediate", "marts"):
        p.add_argument(f"--{layer}", dest=f"layer_{layer}", default=None,
                       help=f"database name of the {layer} layer (used verbatim)")
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"saasmart-{args.step}").getOrCreate()
    lake = I.Lake(args.root or f"{shared_root(spark)}/saasmart/lake")
    layers = C.Layers.named(args.layer_raw, args.layer_staging, args.layer_intermediate,
                            args.layer_marts)
    if args.buckets and not I.buckets(spark, lake):
        I.set_buckets(spark, lake, args.buckets)
    report: dict = {"step": args.step, "root": lake.root}

    if args.step in ("generate", "run"):
        seeds = args.seeds or [random.randint(0, 1_000_000) for _ in range(args.batches)]
        report["seeds"] = seeds
        report["batches"] = L.land_synthetic(spark, lake.landing, seeds, n_users=args.users)
    if args.step == "bootstrap":
        report["written"] = I.bootstrap_raw(spark, lake, (args.seeds or [0])[0], args.users)
    if args.step in ("ingest", "run"):
        I.ingest_all(spark, lake)
    if args.step in ("build", "run"):
        models = PL.build_models(spark, lake, args.select, layers) if args.select else PL.build(spark, lake, layers)
        report["marts"] = {f"{layers.marts}.{m}": models[m].count() for m in PL.MART_TABLES if m in models}
    if args.step in ("audit", "run", "bootstrap"):
        raw = {t: I.read_raw(spark, lake, t) for t in schemas.RAW_TABLES}
        report["row_counts"] = {r.table_name: r.row_count
                                for r in audit.row_counts(raw).collect()}
        report["loaded"] = [r.asDict() for r in
                            audit.ledger_totals(I.read_ledger(spark, lake)).collect()]
    print(json.dumps(report, default=str))
    return report


if __name__ == "__main__":
    main(sys.argv[1:])
