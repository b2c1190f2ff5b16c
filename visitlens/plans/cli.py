"""Command-line entry points, one per reference job (submit with ``spark-submit``).

    python -m visitlens.plans.cli session --task-id 1 --tasks tasks.json \
        --actions /data/user_visit_action --users /data/user_info --out /data/results
    python -m visitlens.plans.cli funnel  --params '{"targetPageFlow": ["1,2,3"]}' ...
    python -m visitlens.plans.cli area    --task-id 2 --tasks tasks.json --actions ... \
        --products /data/product_info --cities /data/city_info --out ...
    python -m visitlens.plans.cli ads     --lines /data/ad_lines --state /data/ad_state \
        --checkpoint /data/ad_ckpt [--log /data/ad_log | --kafka-servers host:9092 --topics t1,t2]

Task parameters come either from a task table (``--tasks``: parquet or JSON lines with
task_id, task_param) looked up by ``--task-id``, or inline as ``--params`` JSON. Inputs
are parquet paths or catalog table names (a path containing '/' is read as parquet).
Each result table is appended under ``--out/<table>``; nothing is collected.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession

from visitlens.plans import jobs
from visitlens.plans.params import TaskParams, task_by_id
from visitlens.session import get_spark
from visitlens.sources import sinks
from visitlens.sources.readers import read_catalog_table, read_parquet


def _table(spark: SparkSession, ref: str) -> DataFrame:
    return read_parquet(spark, ref) if "/" in ref else read_catalog_table(spark, ref)


def _params(spark: SparkSession, args: argparse.Namespace) -> tuple[int, TaskParams]:
    if args.params:
        return args.task_id or 0, TaskParams.from_json(args.params)
    if not args.tasks or args.task_id is None:
        raise SystemExit("give --params, or --tasks with --task-id")
    ref = args.tasks.rstrip("/")
    tasks = spark.read.json(ref) if ref.endswith(".json") else _table(spark, ref)
    return args.task_id, task_by_id(tasks, args.task_id)


def _write(results: dict, out: str) -> None:
    for name, df in jobs.tables(results).items():
        sinks.append(df, os.path.join(out, name))
    jobs.release(results)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    ap = argparse.ArgumentParser(prog="visitlens")
    ap.add_argument("job", choices=["session", "funnel", "area", "ads"])
    ap.add_argument("--task-id", type=int)
    ap.add_argument("--tasks")
    ap.add_argument("--params")
    ap.add_argument("--actions")
    ap.add_argument("--users")
    ap.add_argument("--products")
    ap.add_argument("--cities")
    ap.add_argument("--out")
    ap.add_argument("--materialize", default="checkpoint", choices=["persist", "checkpoint"])
    ap.add_argument("--lines", help="directory of ad click text files (stream source)")
    ap.add_argument("--log", help="append log of ad click lines (stream source)")
    ap.add_argument("--kafka-servers")
    ap.add_argument("--topics")
    ap.add_argument("--state", help="folder of the ad stream's tables")
    ap.add_argument("--checkpoint", help="streaming checkpoint location")
    ap.add_argument("--threshold", type=int, default=100)
    ap.add_argument("--compact-every", type=int, default=720, help="batches between compactions of the ad stream's logs (720: an hour)")
    ap.add_argument("--lateness-seconds", type=int, help="clicks older than the newest by more than this go to late_clicks")
    ap.add_argument("--available-now", action="store_true")
    args = ap.parse_args(argv)
    spark = spark or get_spark()

    if args.job == "ads":
        from visitlens.sources import append_log
        from visitlens.streaming import AdClickStreamJob, kafka_lines, text_lines
        lines = (kafka_lines(spark, args.kafka_servers, args.topics) if args.kafka_servers
                 else append_log.stream(spark, args.log) if args.log else text_lines(spark, args.lines))
        job = AdClickStreamJob(spark, args.state, threshold=args.threshold, compact_every=args.compact_every,
                               lateness_seconds=args.lateness_seconds)
        trigger = {"availableNow": True} if args.available_now else None
        q = job.start(lines, args.checkpoint, trigger)
        q.awaitTermination()
        return

    task_id, params = _params(spark, args)
    actions = _table(spark, args.actions)
    if args.job == "session":
        results = jobs.run_session_job(actions, _table(spark, args.users), params, task_id,
                                       materialize=args.materialize)
    elif args.job == "funnel":
        results = jobs.run_funnel_job(actions, params, task_id)
    else:
        results = jobs.run_area_job(actions, _table(spark, args.cities), _table(spark, args.products),
                                    params, task_id)
    _write(results, args.out)


if __name__ == "__main__":
    main(sys.argv[1:])
