"""Command line: run one of the jobs in ``mercato.jobs`` and show its frames.

    python -m mercato profile    RAW.csv
    python -m mercato clean-load RAW.csv OUT_DIR
    python -m mercato report     OUT_DIR            (the table written by clean-load)
    python -m mercato warehouse  OUT_DIR            (normalise + star from the loaded table)
    python -m mercato transform  LARGE.csv [OUT_DIR]
    python -m mercato formats    SALES_WITH_YEAR_CSV OUT_DIR
    python -m mercato stream     BOOTSTRAP TOPIC OUT_DIR CHECKPOINT   (needs the Kafka connector)
"""

from __future__ import annotations

import argparse

from mercato import jobs
from mercato.operators.upsert import read_current
from mercato.session import CLUSTER_CONF, build_session


def show(frames: dict, save: str | None = None, n: int = 20) -> None:
    """Print the head of each frame; with ``save`` every frame is stored whole under it."""
    for name, df in frames.items():
        if hasattr(df, "show"):
            print(f"== {name}")
            if save:
                df.write.mode("overwrite").parquet(f"{save.rstrip('/')}/{name}")
                df = df.sparkSession.read.parquet(f"{save.rstrip('/')}/{name}")
            df.show(n, truncate=False)
        else:
            print(f"== {name}: {df}")


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(
        prog="python -m mercato", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    ap.add_argument("job", choices=["profile", "clean-load", "report", "warehouse", "transform", "formats", "stream"])
    ap.add_argument("args", nargs="*")
    ap.add_argument("--master", default=None)
    ap.add_argument("--save", default=None, help="folder in which every report is stored whole, as Parquet")
    ap.add_argument("--cluster", action="store_true", help="start from the settings for a large cluster")
    a = ap.parse_args(argv)
    spark = build_session(a.master, extra_conf=CLUSTER_CONF if a.cluster else None)
    if a.job == "profile":
        show(jobs.profile_job(spark, a.args[0]), a.save)
    elif a.job == "clean-load":
        show(jobs.clean_load_job(spark, a.args[0], a.args[1]), a.save)
    elif a.job == "report":
        show(jobs.report_job(spark, read_current(spark, f"{a.args[0]}/orders")), a.save)
    elif a.job == "warehouse":
        orders = read_current(spark, f"{a.args[0]}/orders").drop("loaded_at")
        show(jobs.warehouse_job(spark, orders, a.args[1] if len(a.args) > 1 else f"{a.args[0]}/warehouse"), a.save)
    elif a.job == "transform":
        show(jobs.transform_job(spark, a.args[0], a.args[1] if len(a.args) > 1 else None), a.save)
    elif a.job == "formats":
        show(jobs.format_job(spark, a.args[0], a.args[1]), a.save)
    elif a.job == "stream":
        from mercato.sources.connectors import read_kafka_stream

        records = read_kafka_stream(spark, a.args[0], a.args[1])
        query, bad_query = jobs.stream_job(spark, records, a.args[2], a.args[3], console=True)
        try:
            query.awaitTermination()
        finally:
            query.stop()
            bad_query.stop()
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
