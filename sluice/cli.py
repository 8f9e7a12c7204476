"""Commands: sync, compare, dump-config, tail."""

from __future__ import annotations

import argparse
import logging
import signal
import sys
import threading

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import clone, compare
from .sources import config, log as logs
from .streaming import runner


def set_logging(level: str = "INFO", file: str | None = None) -> None:
    logging.basicConfig(level=level.upper(), format="%(asctime)s.%(msecs)03d %(levelname)s %(message)s", datefmt="%Y-%m-%d %H:%M:%S", handlers=[logging.FileHandler(file, "w") if file else logging.StreamHandler()], force=True)


def sync(spark: SparkSession, args: argparse.Namespace) -> None:
    """Addresses are folders: the sender holds log files, the receiver its versions, a folder a class."""
    if args.once:
        exchange = config.read_config(args.config)[args.exchange]
        for kind in runner.KINDS:
            runner.follow_class(spark, exchange, kind, once=True).awaitTermination()
        return
    stop = threading.Event()
    for number in (signal.SIGINT, signal.SIGTERM):
        signal.signal(number, lambda *_: stop.set())
    runner.serve(spark, args.config, args.exchange, stop)


def compare_tables(spark: SparkSession, args: argparse.Namespace) -> None:
    """Tables are folders under two folders; fields are those that both sides have."""
    jvm = spark.sparkContext._jvm

    def names(folder: str):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
        rows = spark.createDataFrame([(s.getPath().getName(),) for s in found] or [("",)], "name string").where("name <> ''")
        return logs.collections(rows, args.colls)

    sender, receiver = names(args.sender), names(args.receiver)
    for r in clone.not_received(sender, receiver).collect():
        print(f"{r['name']}\tnot received")
    for r in clone.received(sender, receiver).orderBy("name").collect():
        s, t = (spark.read.parquet(f"{x}/{r['name']}").withColumn("__coll", F.lit(r["name"])) for x in (args.sender, args.receiver))
        fields = tuple(c for c in s.columns if c in t.columns and c not in (args.key, "__coll"))
        pairs = compare.paired(s, t, args.key, "__coll", fields)
        report = compare.summary(pairs, fields).where(F.col("coll").isNotNull())
        for line in compare.report_lines(report if args.verbose else compare.differing(report)).collect():
            print(line["line"])
        if args.fields:
            for x in compare.field_counts(pairs, fields).orderBy("field").collect():
                print(f"\t[{x['field']}]:{x['n']}")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sluice", description=__doc__)
    parser.add_argument("--loglevel", default="INFO")
    parser.add_argument("--logfile")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("sync")
    p.add_argument("--config", required=True)
    p.add_argument("--exchange", type=int, default=0)
    p.add_argument("--once", action="store_true")
    p = sub.add_parser("compare")
    p.add_argument("sender")
    p.add_argument("receiver")
    p.add_argument("--key", default="_id")
    p.add_argument("--colls", default="")
    p.add_argument("--fields", action="store_true")
    p.add_argument("--verbose", action="store_true")
    p = sub.add_parser("dump-config")
    p.add_argument("config")
    p.add_argument("--format", choices=("yaml", "json"), default="yaml")
    p = sub.add_parser("tail")
    p.add_argument("log")
    p.add_argument("--after")
    args = parser.parse_args(argv)
    set_logging(args.loglevel, args.logfile)
    if args.command == "dump-config":
        sys.stdout.write(config.dump(config.read_config(args.config), args.format))
        return 0
    spark = SparkSession.builder.appName("sluice").getOrCreate()
    if args.command == "sync":
        sync(spark, args)
    elif args.command == "compare":
        compare_tables(spark, args)
    else:
        logs.tail(logs.stream_log(spark, args.log, args.after)).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
