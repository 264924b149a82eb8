"""Job entry points for spark-submit.

  python -m build --wheel            (or: zip -r tidemark.zip tidemark)
  spark-submit --py-files tidemark.zip --conf spark.checkpoint.dir=hdfs:///tmp/ck tidemark/jobs.py train \\
      --input DIR_OR_FILE --snapshot 2025-06-04 --model-dir OUT
  spark-submit ... tidemark/jobs.py score   --requests GLOB --model-dir DIR --out OUT [--multiline]
  spark-submit ... tidemark/jobs.py analyze --input DIR_OR_FILE --snapshot 2025-06-04 --model-dir DIR --out OUT

The session comes from the cluster (``getOrCreate``); the package is shipped to
the workers by ``ship_package``, so a plain ``python -m tidemark.jobs`` against a
cluster works too.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from tidemark import config as C
from tidemark import sinks
from tidemark.operators.cleaning import clean_strict
from tidemark.plans.analysis import rfm_vs_clv, target_list, underrated
from tidemark.plans.scoring import response_json, score_customers
from tidemark.plans.training import train_all, train_lenient
from tidemark.session import ensure_checkpoint_dir, ship_package
from tidemark.sinks.store import Store
from tidemark.sources import read_lenient, read_transactions, training_paths
from tidemark.sources.requests import flatten_requests, read_requests, rejected_requests, rejected_visits, request_defaults


def _input(spark, path: str, lenient: bool):
    paths = training_paths(path, spark) if sinks.is_folder(spark, path) else [path]
    return read_lenient(spark, paths) if lenient else read_transactions(spark, paths)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("--input", required=True)
    t.add_argument("--snapshot", required=True)
    t.add_argument("--model-dir", required=True)
    t.add_argument("--penalizer", type=float, default=0.0)
    t.add_argument("--bgnbd-penalizer", type=float, default=None)
    t.add_argument("--by-channel", action="store_true")
    t.add_argument("--lenient", action="store_true")
    s = sub.add_parser("score")
    s.add_argument("--requests", required=True)
    s.add_argument("--model-dir", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--lenient", action="store_true")
    s.add_argument("--multiline", action="store_true")
    a = sub.add_parser("analyze")
    a.add_argument("--input", required=True)
    a.add_argument("--snapshot", required=True)
    a.add_argument("--model-dir", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--xdays", type=int, default=C.DEFAULT_XDAYS)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"tidemark-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    if args.cmd == "train":
        txn = _input(spark, args.input, args.lenient)
        if args.lenient:
            models, metrics = train_lenient(txn, args.snapshot, penalizer=args.penalizer or 0.1,
                                            bgnbd_penalizer=args.bgnbd_penalizer)
        else:
            models, metrics = train_all(txn, args.snapshot, penalizer=args.penalizer,
                                        bgnbd_penalizer=args.bgnbd_penalizer, by_channel=args.by_channel)
        Store(spark, args.model_dir).publish(models, metrics)
    elif args.cmd == "score":
        models = Store(spark, args.model_dir).load()
        requests = request_defaults(read_requests(spark, args.requests, args.multiline),
                                    zero_is_missing=not args.lenient, config=models.config).persist()
        preds = score_customers(flatten_requests(requests), models, lenient=args.lenient).persist()
        preds.write.mode("overwrite").parquet(os.path.join(args.out, "predictions"))
        sinks.write_responses(response_json(preds, requests), os.path.join(args.out, "responses"))
        rejected_requests(requests).write.mode("overwrite").json(os.path.join(args.out, "rejected_requests"))
        rejected_visits(requests).write.mode("overwrite").json(os.path.join(args.out, "rejected_visits"))
    else:
        models = Store(spark, args.model_dir).load()
        txn = _input(spark, args.input, False)
        report = rfm_vs_clv(clean_strict(txn, args.snapshot), args.snapshot, models, args.xdays,
                            per_channel=bool(models.cox_by_channel))
        sinks.write_csv(report, os.path.join(args.out, "customer_clv"))
        sinks.write_csv(target_list(report), os.path.join(args.out, "target_list"))
        sinks.write_csv(underrated(report), os.path.join(args.out, "underrated"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
