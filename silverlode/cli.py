"""Commands: ``emulate``, ``update``, ``invariants``; each takes ``--key=value`` parameters.

``--catalog`` names the tables' catalog, or a folder that holds them; with a name, ``--warehouse`` is the
folder (else one of that name under Spark's warehouse), and every table is also found by its name.
"""

from __future__ import annotations

import re
import sys
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from .operators.dq import GateError
from .plans import config, scenarios
from .plans.medallion import Pipeline
from .session import create_session
from .sources import landing
from .sources.tables import Warehouse


def emulate(scenario: str, root: str, variant: str | None = None) -> int:
    files = scenarios.generate(scenarios.load(scenario), variant)
    for path in landing.write(files, root, config.load_sources(), config.load_source_contracts()):
        print(path)
    return 0


def open_warehouse(spark: SparkSession, params: config.Params) -> Warehouse:
    """The tables of a catalog that is a plain name, by name and folder; or of a folder."""
    if not re.fullmatch(r"\w+", params.catalog):
        return Warehouse(spark, params.warehouse or params.catalog)
    params = replace(params, shared=spark.conf.get(f"spark.sql.catalog.{params.catalog}", None) is None)
    return Warehouse(spark, params.warehouse or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{params.catalog}", params)


def _pipeline(args: list[str], as_of: str | None) -> Pipeline:
    params = config.resolve_params(args)
    spark = create_session()
    at = datetime.fromisoformat(as_of) if as_of else datetime.now(timezone.utc)
    warehouse = open_warehouse(spark, params)
    return Pipeline(spark, params.landing, warehouse, f"{warehouse.root}/_checkpoints", at, params.lateness_days, params.funnel_hours)


def report(broken: DataFrame) -> int:
    """Print every violation, read a part at a time; 1 if there are any."""
    found = 0
    for r in broken.toLocalIterator():
        print(f"{r['subject']} {r['key']}: {r['violation']}")
        found = 1
    return found


def update(args: list[str], as_of: str | None = None) -> int:
    """Run the pipeline; a broken invariant is exit status 1, a gate 2."""
    try:
        return report(_pipeline(args, as_of).run())
    except GateError as e:
        print(e)
        return 2


def invariants(args: list[str]) -> int:
    """Check the tables as they stand, without a run; a broken invariant is exit status 1."""
    return report(_pipeline(args, None).invariants())


def main(argv: list[str]) -> int:
    command, *args = argv or ["help"]
    named = dict(a.removeprefix("--").split("=", 1) for a in args if a.startswith("--") and "=" in a)
    if command == "emulate" and {"scenario", "landing"} <= named.keys():
        return emulate(named["scenario"], named["landing"], named.get("variant"))
    if command == "update":
        return update([a for a in args if not a.startswith("--as_of=")], named.get("as_of"))
    if command == "invariants":
        return invariants(args)
    print(__doc__)
    return 64


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
