"""Command line: the jobs of the source project, on table paths.

    python -m keelson bronze --table bookings --kafka-bootstrap HOST:PORT --topic T --out P --checkpoint C
    python -m keelson silver --table bookings --bronze P --out P [--format parquet]
    python -m keelson silver --table bookings --bronze P --out P --state S [--since YYYY-MM-DD]
    python -m keelson gold --tables DIR --out DIR [--format parquet]
    python -m keelson dq --table bookings --input P --tables DIR --out P

``gold`` reads reference tables (airports, customers, fare_classes,
fare_rules, aircraft_models) and the silver_* tables from ``--tables``
(one table per sub-folder) and writes dimensions, then facts, to ``--out``.
A reference table can come over JDBC instead: ``--jdbc airports=URL``
(repeatable; user / password from JDBC_USER / JDBC_PASSWORD).
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="keelson")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bronze")
    b.add_argument("--table", required=True)
    b.add_argument("--kafka-bootstrap", required=True)
    b.add_argument("--topic", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--checkpoint", required=True)
    b.add_argument("--trigger-seconds", type=int, default=10)
    b.add_argument("--dedupe", choices=["change", "first_arrival", "none"], default="change")
    s = sub.add_parser("silver")
    s.add_argument("--table", required=True)
    s.add_argument("--bronze", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--format", default="parquet")
    s.add_argument("--state", help="incremental: bucketed current-state table to merge into")
    s.add_argument("--since", help="incremental: read Bronze ingest_date partitions from this date")
    g = sub.add_parser("gold")
    g.add_argument("--tables", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--format", default="parquet")
    g.add_argument("--jdbc", action="append", default=[], metavar="TABLE=URL")
    d = sub.add_parser("dq")
    d.add_argument("--table", required=True)
    d.add_argument("--input", required=True, help="the table to test (e.g. its Silver)")
    d.add_argument("--tables", required=True, help="folder of the referenced tables")
    d.add_argument("--out", required=True)
    d.add_argument("--format", default="parquet")
    args = ap.parse_args(argv)

    from keelson.plans import jobs as J
    from keelson.plans.presets import ALL_CAPTURED, SPECS
    from keelson.session import build_session
    from keelson.sinks import tables as sinks
    from keelson.streaming import ingest

    spark = build_session(app=f"keelson-{args.cmd}")
    if args.cmd == "bronze":
        raw = ingest.kafka_source(spark, {"kafka.bootstrap.servers": args.kafka_bootstrap, "subscribe": args.topic})
        q = J.bronze_query(raw, ALL_CAPTURED[args.table], args.out, args.checkpoint,
                           trigger={"processingTime": f"{args.trigger_seconds} seconds"},
                           dedupe=None if args.dedupe == "none" else args.dedupe)
        q.awaitTermination()
    elif args.cmd == "silver":
        spec = SPECS[args.table]
        bronze = sinks.read(spark, args.bronze, args.format)
        if args.state:
            from pyspark.sql import functions as F
            if args.since:
                bronze = bronze.filter(F.col("ingest_date") >= F.lit(args.since).cast("date"))
            J.silver_incremental(spark, bronze, spec, args.state, f"{args.out}/silver_all_{spec.name}", fmt=args.format)
        else:
            import json
            from pyspark.sql import functions as F
            from keelson.operators import quality as Q
            # Bronze is read and aggregated once: the checked rows are stored, then split
            checked, obs = Q.observe_counts(J.checked_state(bronze, spec), "silver", {"valid": F.col("_valid")})
            sinks.write_split(checked, f"{args.out}/silver_checked_{spec.name}", args.format)
            whole = sinks.read(spark, f"{args.out}/silver_checked_{spec.name}", args.format)
            # a partition column reads back as text
            silver, quarantine = J.split_checked(whole.withColumn("_valid", F.col("_valid").cast("boolean")), spec)
            sinks.overwrite(silver, f"{args.out}/silver_{spec.name}", args.format)
            sinks.overwrite(quarantine, f"{args.out}/silver_quarantine_{spec.name}", args.format)
            # row counts gathered during the write (no extra counting pass)
            print(json.dumps({"table": spec.name, "silver_rows": obs.get["valid"],
                              "quarantine_rows": obs.get["rows"] - obs.get["valid"]}))
    elif args.cmd == "dq":
        report = J.dq_job(args.table, sinks.read(spark, args.input, args.format),
                          lambda name: sinks.read(spark, f"{args.tables}/{name}", args.format))
        sinks.overwrite(report, args.out, args.format)
    else:
        from pyspark.errors import AnalysisException
        from keelson.sources.tables import read_jdbc
        jdbc = dict(item.split("=", 1) for item in args.jdbc)

        def read(name):
            if name in jdbc:
                return read_jdbc(spark, jdbc[name], name)
            base = args.out if name.startswith("dim_") else args.tables
            return sinks.read(spark, f"{base}/{name}", args.format)

        def write(name, df):
            sinks.overwrite(df, f"{args.out}/{name}", args.format)

        def previous(name):
            try:
                return sinks.read(spark, f"{args.out}/{name}", args.format)
            except AnalysisException:
                return None
        J.run_gold(spark, read, write, previous)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
