"""Command-line entry points mirroring the reference's jobs.

    python -m meterlens.cli stream   --kafka HOST:PORT --base PATH [--topic T]
    python -m meterlens.cli stream   --source-dir DIR --base PATH   (Kafka-shaped parquet files)
    python -m meterlens.cli register --db NAME --base PATH
    python -m meterlens.cli report   --zone PATH --out PATH

Masters, executors and ``spark.checkpoint.dir`` come from spark-submit.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from meterlens.config import TOPIC, TRIGGER_INTERVAL, session
from meterlens.operators import summary
from meterlens.plans.writes import FILES_PER_BATCH
from meterlens.schema import KAFKA_SCHEMA
from meterlens.sources import catalog
from meterlens.sources.kafka import read_kafka_stream
from meterlens.streaming.zones import ZonePaths, run_pipeline, write_zones_batch


def _stream(spark: SparkSession, a) -> None:
    if a.kafka:
        opts = {"maxOffsetsPerTrigger": str(a.max_offsets)} if a.max_offsets else {}
        src = read_kafka_stream(spark, a.kafka, a.topic, **opts)
    else:
        src = spark.readStream.schema(KAFKA_SCHEMA).parquet(a.source_dir)
    paths = ZonePaths.under(spark, a.base)
    trigger = "availableNow" if a.once else a.trigger
    if a.single_query:
        q = write_zones_batch(src, paths, trigger, files_per_partition=a.files_per_partition)
        q.awaitTermination()
    else:
        qs = run_pipeline(src, paths, trigger, console=not a.no_console,
                          files_per_partition=a.files_per_partition)
        if a.once:
            for q in qs:
                q.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()


def _register(spark: SparkSession, a) -> None:
    catalog.create_database(spark, a.db, a.location)
    for table, sub in (("raw_readings", "raw"), ("meter_features", "processed"),
                       ("fraud_alerts", "alerts")):
        catalog.register_zone(spark, a.db, table, os.path.join(a.base, sub))
    catalog.show_tables(spark, a.db).show(truncate=False)


def _report(spark: SparkSession, a) -> None:
    mf = catalog.read_zone(spark, a.zone, "meter_features")
    frames = summary.report_frames(mf)  # one scan of the zone
    s = frames["summary"]
    catalog.export_summary_csv(s, os.path.join(a.out, "fraud_summary"))
    for name, df in (("meter_table", summary.meter_table(s)), ("hourly", frames["hourly"]),
                     ("daily_trend", frames["daily_trend"]), ("severity", frames["severity"])):
        df.write.mode("overwrite").parquet(os.path.join(a.out, name))
    totals = summary.fleet_totals(s).first().asDict()
    print(json.dumps(totals))


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="meterlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    st = sub.add_parser("stream")
    st.add_argument("--kafka")
    st.add_argument("--topic", default=TOPIC)
    st.add_argument("--source-dir")
    st.add_argument("--max-offsets", type=int, default=None,
                    help="maxOffsetsPerTrigger: bound the records of one micro-batch")
    st.add_argument("--base", required=True)
    st.add_argument("--trigger", default=TRIGGER_INTERVAL)
    st.add_argument("--once", action="store_true", help="process what is there, then stop")
    st.add_argument("--single-query", action="store_true", help="one foreachBatch query for all zones")
    st.add_argument("--no-console", action="store_true")
    st.add_argument("--files-per-partition", type=int, default=FILES_PER_BATCH,
                    help="cluster each micro-batch so a zone directory gets at most N files")
    rg = sub.add_parser("register")
    rg.add_argument("--db", default="meterlens")
    rg.add_argument("--location")
    rg.add_argument("--base", required=True)
    rp = sub.add_parser("report")
    rp.add_argument("--zone", required=True)
    rp.add_argument("--out", required=True)
    a = p.parse_args(argv)
    spark = session("meterlens-" + a.cmd)
    {"stream": _stream, "register": _register, "report": _report}[a.cmd](spark, a)


if __name__ == "__main__":
    main()
