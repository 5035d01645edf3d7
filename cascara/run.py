"""Run one catalog query as a batch job and write its result.

    spark-submit cascara/run.py <query> <data_dir> <out_path> [--format csv|parquet|text]
    python -m cascara.run top_rated /data/sf100 /out/top_rated --format csv

The master, executors and ``spark.checkpoint.dir`` come from spark-submit /
the cluster configuration. The output path must not exist (errorifexists),
as with the reference's text outputs.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str] | None = None) -> int:
    from cascara.plans.catalog import QUERIES
    from cascara.session import build_session, scratch_scope
    from cascara.sources import write_csv, write_text

    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    p.add_argument("query", choices=sorted(QUERIES))
    p.add_argument("data_dir")
    p.add_argument("out")
    p.add_argument("--format", choices=["csv", "parquet", "text"], default="parquet")
    args = p.parse_args(argv)

    spark = build_session(app_name=f"cascara-{args.query}")
    with scratch_scope(spark):  # intermediate tables go once the result is written
        df = QUERIES[args.query](spark, args.data_dir)
        if args.format == "csv":
            write_csv(df, args.out, header=True)
        elif args.format == "text":
            write_text(df, args.out)
        else:
            df.write.mode("errorifexists").parquet(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
