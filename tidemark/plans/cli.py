"""spark-submit main: sync, validate, optionset-config (#62-#64)."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import schema_diff
from ..sources import metadata
from ..sources.catalog import store_schemas
from ..sources.config import load_entities, load_option_sets, load_settings
from ..sources.odata import Authenticator
from ..sources.store import Store
from . import report, workflow


def _source(spark: SparkSession, env: str | None) -> workflow.ODataRecords:
    s = load_settings(env)
    auth = Authenticator(s.api_url, s.client_id, s.client_secret, s.scope)
    return workflow.ODataRecords(spark, s.api_url, auth)


def sync(spark: SparkSession, args: argparse.Namespace) -> int:
    ok = workflow.run_sync(spark, args.store, _source(spark, args.env_file), args.entities, args.optionsets, args.verify, print)
    return 0 if ok else 1


def validate(spark: SparkSession, args: argparse.Namespace) -> int:
    document = metadata.read_document(spark, args.metadata) if args.metadata else _source(spark, args.env_file).metadata()
    entities = load_entities(args.entities)
    schemas = metadata.parse(document, option_sets=load_option_sets(args.optionsets))
    actual = store_schemas(Store(spark, args.store))
    _, _, differences, _ = schema_diff.gate(spark, schemas, actual, entities)
    found = report.collected(differences)
    names = {e.api_name for e in entities if e.name in schemas}
    for path, text in ((args.json, report.as_json), (args.markdown, report.as_markdown)):
        if path:
            Path(path).write_text(text(found, names, {t for t in actual if not t.startswith("_")}), encoding="utf-8")
    text, ok = report.console(found)
    print(text)
    return 0 if ok else 1


def optionset_config(spark: SparkSession, args: argparse.Namespace) -> int:
    store = Store(spark, args.store)
    lookups = store.read(workflow.LOOKUPS).select("field") if store.exists(workflow.LOOKUPS) else spark.createDataFrame([], "field string")
    columns = [(n, c.name, c.db_type) for n, s in store_schemas(store).items() if not n.startswith("_") for c in s.columns if c.name != "row_id"]
    found = schema_diff.option_set_config(lookups, spark.createDataFrame(columns, "entity string, column string, db_type string"))
    names = {e.api_name: e.name for e in load_entities(args.entities)} if args.entities else {}
    config = {names.get(r["entity"], r["entity"]): r["fields"] for r in found.orderBy(F.col("entity")).collect()}
    text = json.dumps(config, indent=2, sort_keys=True)
    if args.output:
        Path(args.output).write_text(text + "\n", encoding="utf-8")
    else:
        print(text)
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, run, needs in (("sync", sync, True), ("validate", validate, True), ("optionset-config", optionset_config, False)):
        p = commands.add_parser(name)
        p.set_defaults(run=run)
        p.add_argument("--store", required=True, help="folder of the table store")
        p.add_argument("--entities", required=needs, help="JSON file of the entities")
        p.add_argument("--env-file")
        p.add_argument("--optionsets", help="JSON file of coded fields by entity")
        if name == "sync":
            p.add_argument("--verify", action="store_true", help="verify references afterwards")
        if name == "validate":
            p.add_argument("--metadata", help="metadata document, instead of the service's")
            p.add_argument("--json")
            p.add_argument("--markdown")
        if name == "optionset-config":
            p.add_argument("--output")
    args = parser.parse_args(argv)
    return args.run(spark or SparkSession.builder.appName("tidemark").getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())
