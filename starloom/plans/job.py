"""The warehouse load as a runnable job (the counterpart of the original script).

    python -m starloom --sf-dir /root/testdata/sf0.01 --out /shared/warehouse
    python -m starloom --tables /data/oltp --out /shared/warehouse --plan two-stage

``--tables DIR`` reads the six operational tables as Parquet directories
``DIR/{sale,product,category,product_categories,room,member}``; ``--sf-dir``
builds them from the test tables instead. The run writes all five warehouse
tables under ``<out>/runs/<run_id>/``, checks them, publishes the run if no check fails and prints
the integrity report (one line per check) as JSON lines.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from starloom import schemas
from starloom.operators.categories import level_map
from starloom.operators.checks import warehouse_report
from starloom.plans import publish, star
from starloom.session import build_session, configure
from starloom.sources.fixtures import Sources

OPERATIONAL = ("sale", "product", "category", "product_categories", "room", "member")


def operational_from(spark: SparkSession, tables_dir: str) -> star.Operational:
    base = tables_dir.rstrip("/")
    return star.Operational(**{t: spark.read.parquet(f"{base}/{t}") for t in OPERATIONAL})


def run(spark: SparkSession, src: star.Operational, levels, out: str, plan: str = "keys-first",
        on_missing_product: str = "default", **options) -> tuple[str, list[dict]]:
    """Load, write, check, publish. ``options`` go to the load
    (``insert_only_product``, ``pad_day_name``)."""
    configure(spark)
    load = star.keys_first_load if plan == "keys-first" else star.two_stage_load
    wh = load(spark, src, levels, on_missing_product, **options)
    run_id = publish.write_run(spark, wh.tables(), root=out, publish=False)
    wh.release()
    tables = {t: publish.read_table(spark, t, root=out, run_id=run_id) for t in wh.tables()}
    report = warehouse_report(tables, schemas.PRIMARY_KEYS, schemas.FOREIGN_KEYS, schemas.MAX_LENGTH,
                              schemas.NATURAL_KEYS, {"salesfact": ("kroner_sales", 10, 2)})
    rows = [r.asDict() for r in report.collect()]
    # a run that breaks a constraint is never published: readers keep the old one
    if not any(r["violations"] for r in rows):
        publish.publish_run(spark, run_id, out)
    return run_id, rows


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="starloom", description=__doc__.split("\n\n")[0])
    src_arg = ap.add_mutually_exclusive_group(required=True)
    src_arg.add_argument("--tables", help="directory with the six operational Parquet tables")
    src_arg.add_argument("--sf-dir", help="test-table directory; fixture views are built from it")
    ap.add_argument("--out", required=True, help="shared output folder of the warehouse")
    ap.add_argument("--plan", choices=("keys-first", "two-stage"), default="keys-first")
    ap.add_argument("--on-missing-product", choices=("default", "error", "null"), default="default")
    ap.add_argument("--insert-only-product", action="store_true", help="known products keep their status")
    ap.add_argument("--pad-day-name", action="store_true", help="weekday names padded to nine characters")
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    args = ap.parse_args(argv)

    spark = build_session(args.master) if args.master else SparkSession.builder.getOrCreate()
    if args.sf_dir:
        fixtures = Sources(spark, args.sf_dir)
        src = star.Operational(sale=fixtures.sale, product=fixtures.product, category=fixtures.category(),
                               product_categories=fixtures.product_categories(), room=fixtures.room,
                               member=fixtures.member)
        levels = fixtures.level_map()
    else:
        src = operational_from(spark, args.tables)
        levels = level_map(spark)
    run_id, report = run(spark, src, levels, args.out, args.plan, args.on_missing_product,
                         insert_only_product=args.insert_only_product, pad_day_name=args.pad_day_name)
    print(json.dumps({"run_id": run_id, "out": args.out}))
    for row in report:
        print(json.dumps(row))
    return 1 if any(r["violations"] for r in report) else 0
