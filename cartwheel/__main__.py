"""Command line for the landing, refresh and question steps.

    python -m cartwheel land-orders   DOCS LAKE            # documents -> lake rows
    python -m cartwheel land-edits    DOCS LAKE
    python -m cartwheel refresh-orders LAKE WAREHOUSE [--cleanup] [--keep N]
    python -m cartwheel refresh-edits  LAKE WAREHOUSE [--cleanup] [--keep N]
    python -m cartwheel stream-orders  LAKE WAREHOUSE CHECKPOINT [--every "10 minutes"]
    python -m cartwheel stream-edits   LAKE WAREHOUSE CHECKPOINT [--every "10 minutes"]
    python -m cartwheel question KEY WAREHOUSE [--out PATH]

The session comes from ``spark-submit``/the cluster defaults when present
(``--master`` defaults to local[*] otherwise).  ``question`` runs one of the
question functions against the latest published snapshot and shows it, or
writes it as Parquet with ``--out``.
"""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import SparkSession

from .plans import batch, questions, refresh
from .session import SESSION_DEFAULTS, ensure_checkpoint_dir
from .sources import documents
from .streaming import refresh as stream

_MART_ARGS = {"items", "product", "department", "hourly"}


def _session(master: str | None) -> SparkSession:
    builder = SparkSession.builder.appName("cartwheel")
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _question(spark: SparkSession, key: str, warehouse: str):
    fn = getattr(questions, key, None)
    if fn is None or not (key.startswith(("q", "x_", "v_"))):
        raise SystemExit(f"unknown question {key!r}")
    snap = refresh.load_orders(spark, warehouse)
    params = [p for p in inspect.signature(fn).parameters if p in _MART_ARGS]
    return fn(*[getattr(snap, p) for p in params])


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="cartwheel")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("land-orders", "land-edits"):
        p = sub.add_parser(name)
        p.add_argument("docs")
        p.add_argument("lake")
        p.add_argument("--whole-file", action="store_true")
    for name in ("refresh-orders", "refresh-edits"):
        p = sub.add_parser(name)
        p.add_argument("lake")
        p.add_argument("warehouse")
        p.add_argument("--cleanup", action="store_true", help="delete the files that were read")
        p.add_argument("--keep", type=int, default=None, help="keep only the last snapshots")
    for name in ("stream-orders", "stream-edits"):
        p = sub.add_parser(name)
        p.add_argument("lake")
        p.add_argument("warehouse")
        p.add_argument("checkpoint")
        p.add_argument("--every", default=None, help='e.g. "10 minutes"; default: run once')
        p.add_argument("--clean-source", default="off", choices=["off", "archive", "delete"])
        p.add_argument("--archive-dir", default=None)
    p = sub.add_parser("question")
    p.add_argument("key")
    p.add_argument("warehouse")
    p.add_argument("--out", default=None)
    args = ap.parse_args(argv)

    spark = _session(args.master)  # none given: the submit configuration decides
    if args.cmd == "land-orders":
        documents.land_order_documents(spark, args.docs, args.lake, whole_file=args.whole_file)
    elif args.cmd == "land-edits":
        documents.land_edit_documents(spark, args.docs, args.lake, whole_file=args.whole_file)
    elif args.cmd == "refresh-orders":
        print(batch.run_orders_batch(spark, args.lake, args.warehouse, cleanup=args.cleanup, keep=args.keep))
    elif args.cmd == "refresh-edits":
        print(batch.run_edits_batch(spark, args.lake, args.warehouse, cleanup=args.cleanup, keep=args.keep))
    elif args.cmd in ("stream-orders", "stream-edits"):
        start = stream.start_order_refresh if args.cmd == "stream-orders" else stream.start_edit_refresh
        start(spark, args.lake, args.warehouse, args.checkpoint, processing_time=args.every,
              clean_source=args.clean_source, archive_dir=args.archive_dir).awaitTermination()
    elif args.cmd == "question":
        df = _question(spark, args.key, args.warehouse)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(50, truncate=False)


if __name__ == "__main__":
    main()
