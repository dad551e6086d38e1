"""Command line: ``run`` loads files, ``tables`` creates, checks, seeds or drops the tables."""

import argparse
import json
import sys

from pyspark.sql import SparkSession

from tillroll.plans.run import run
from tillroll.plans.warehouse import Warehouse
from tillroll.schema import TABLES


def create(warehouse, given):
    warehouse.reset(seed=not given.empty)
    return {"created": sorted(TABLES), "seeded": not given.empty}


def check(warehouse, given):
    found = {
        name: {"columns": columns, "in_order": fine}
        for name, columns, fine in warehouse.verify_columns()
    }
    return {"tables": found, "failed": [name for name, t in found.items() if not t["in_order"]]}


def seed(warehouse, given):
    before = warehouse.version
    return {"added": warehouse.seed().version > before}


def drop(warehouse, given):
    return {"dropped": [t for t in TABLES if warehouse.exists(t)], "version": warehouse.drop().version}


TABLE_COMMANDS = {
    "create": (create, "start over with empty tables"),
    "check": (check, "compare the tables' columns with the declared ones"),
    "seed": (seed, "add missing fixed entries"),
    "drop": (drop, "take all tables out of use"),
}


def arguments(argv):
    parser = argparse.ArgumentParser(prog="tillroll")
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("run", help="check and load transaction files")
    load.add_argument("--source", choices=["local", "s3"], default="local")
    load.add_argument("--csv", required=True)
    load.add_argument("--holidays", required=True)
    load.add_argument("--warehouse", required=True)
    load.add_argument("--load-id", help="by default the files name the load")
    load.add_argument("--rejects")
    load.add_argument("--dry-run", action="store_true")
    load.add_argument("--multi-line", action="store_true", help="cells may hold line breaks")
    tables = commands.add_parser("tables", help="create, check, seed or drop the tables")
    actions = tables.add_subparsers(dest="action", required=True)
    for name, (_, text) in TABLE_COMMANDS.items():
        action = actions.add_parser(name, help=text)
        action.add_argument("--warehouse", required=True)
        if name == "create":
            action.add_argument("--empty", action="store_true", help="without fixed entries")
    return parser.parse_args(argv)


def main(argv=None):
    given = arguments(argv)
    spark = SparkSession.builder.appName("tillroll").getOrCreate()
    if given.command == "run":
        result = run(
            spark,
            given.csv,
            given.holidays,
            given.warehouse,
            source=given.source,
            load_id=given.load_id,
            rejects_root=given.rejects,
            dry_run=given.dry_run,
            multi_line=given.multi_line,
        )
        ok = result["status"] == "success"
    else:
        command, _ = TABLE_COMMANDS[given.action]
        result = command(Warehouse(spark, given.warehouse), given)
        ok = not result.get("failed")
    print(json.dumps(result, indent=2))
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
