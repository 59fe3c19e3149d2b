"""Command line for scheduled runs (the reference schedules three notebooks
every two minutes; here each step is one command).

    python -m lossline reference --root <path>
    python -m lossline ingest --root <path> --jdbc-url <url> --table <t> [--driver <cls>] [--overlap N]
        [--jdbc-option user=<u>] [--jdbc-options-file <json>] [--column "CAST(x AS DATE) AS x" ...]
    python -m lossline ingest --root <path> --parquet <folder> --source <name>
    python -m lossline refresh --root <path> [--state-partitions N] [--max-files N] [--reset-on-rule-change]
    python -m lossline rebuild --root <path> [--partition-by claim_month] [--quarantine] [--sketches]
    python -m lossline health --root <path>
    python -m lossline quality --root <path>          # quality counts of recent refreshes
    python -m lossline views --root <path> [--schema claims_lakehouse]

Each command prints one JSON line describing what it did. Credentials go into
``--jdbc-option`` or, kept off the command line, ``--jdbc-options-file``; the
source name that bronze records holds neither them nor URL parameters.
"""

from __future__ import annotations

import argparse
import json
import re
import sys

from .config import TABLES
from .operators.quality import quality_history
from .plans import incremental, jobs
from .plans.sql import register_views
from .session import build_session
from .sinks.tables import TableStore, store_health
from .sources import jdbc

HEALTH = {
    "silver.claims": TABLES.silver,
    "silver.claims_by_batch": TABLES.silver_batches,
    "gold.gold_loss_ratio": TABLES.gold_loss_ratio,
    "gold.gold_claims_by_lob_region": TABLES.gold_by_lob_region,
    "gold.gold_claims_daily": TABLES.gold_claims_daily,
    "reference.firmwide_exposure": TABLES.firmwide,
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lossline")
    p.add_argument("command", choices=["reference", "ingest", "refresh", "rebuild", "health", "quality", "views"])
    p.add_argument("--root", required=True, help="table store root (a shared filesystem URI)")
    p.add_argument("--master", default=None)
    p.add_argument("--scale", action="store_true", help="apply the large-cluster settings (session.SCALE_CONF)")
    p.add_argument("--jdbc-url")
    p.add_argument("--table", help="source table, e.g. claims.claim_transactions")
    p.add_argument("--driver")
    p.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE",
                   help="connection property (user, fetchsize, ...); repeatable")
    p.add_argument("--jdbc-options-file", help="JSON object of connection properties, e.g. the password")
    p.add_argument("--column", action="append",
                   help="column or cast evaluated by the database; repeatable (default: every column)")
    p.add_argument("--partitions", type=int, default=8, help="parallel JDBC key ranges")
    p.add_argument("--parquet", help="folder of source parquet files")
    p.add_argument("--source", help="source name recorded in _source (default: host and table, or the folder)")
    p.add_argument("--overlap", type=int, default=0, help="ids re-read below the watermark for late commits")
    p.add_argument("--schema", default="claims_lakehouse")
    p.add_argument("--last", type=int, default=20, help="refresh runs shown by 'quality'")
    p.add_argument("--partition-by", help="rebuild: partition silver by this column (e.g. claim_month)")
    p.add_argument("--quarantine", action="store_true", help="rebuild, refresh: also write failing rows with rule names")
    p.add_argument("--sketches", action="store_true", help="rebuild: also write HLL claim sketches")
    p.add_argument("--state-partitions", type=int, help="refresh: shuffle partitions of its micro-batches, fixed at first start")
    p.add_argument("--max-files", type=int, help="refresh: silver files of one micro-batch at most (a backlog takes several)")
    p.add_argument("--replay-on-rule-change", action="store_true",
                   help="refresh: judge the rows that changed quality rules touch again (needs --quarantine refreshes)")
    p.add_argument("--reset-on-rule-change", action="store_true",
                   help="refresh: re-derive silver and gold when the quality rules changed")
    return p


def source_name(url: str, table: str) -> str:
    """Database and table of a JDBC URL, without its parameters and user part."""
    place = re.split(r"[?;]", url, maxsplit=1)[0]
    if "@" in place:
        place = f"jdbc:{place.split(':')[1]}://{place.rsplit('@', 1)[1].lstrip('/')}"
    return f"{place}/{table}"


def _jdbc_options(args) -> dict[str, str]:
    opts = {"driver": args.driver} if args.driver else {}
    if args.jdbc_options_file:
        with open(args.jdbc_options_file, encoding="utf-8") as f:
            opts.update(json.load(f))
    for option in args.jdbc_option:
        key, eq, value = option.partition("=")
        if not eq:
            raise SystemExit(f"--jdbc-option needs KEY=VALUE, not {key!r}")
        opts[key] = value
    return opts


def _source(spark, args):
    if args.jdbc_url:
        name = args.source or source_name(args.jdbc_url, args.table)
        opts = _jdbc_options(args)
        w, _ = jobs.log_state(TableStore(spark, args.root), name)
        lo, hi = jdbc.key_bounds(spark, args.jdbc_url, args.table, "claim_txn_id", w - args.overlap, **opts)
        if hi is None:
            return None, name
        # the slice is bounded [lo, hi] by the ids that are there, so key ranges
        # are even, and ingest observes count and max on its write instead of
        # asking the database again
        return (jdbc.read_slice(spark, args.jdbc_url, args.table, "claim_txn_id", lo - 1, hi,
                                num_partitions=args.partitions, columns=args.column, **opts), name)
    if args.parquet:
        return spark.read.parquet(args.parquet), args.source or args.parquet
    raise SystemExit("ingest needs --jdbc-url/--table or --parquet")


def _repoint_views(spark, store: TableStore, schema: str, out: dict) -> None:
    """Views made by ``views`` follow the versions that a job has just written."""
    if spark.catalog.databaseExists(schema):
        out["views"] = register_views(spark, store, schema)


def run(args: argparse.Namespace, spark) -> dict:
    store = TableStore(spark, args.root)
    out: dict = {"command": args.command}
    if args.command == "reference":
        out["path"] = jobs.build_reference(spark, store)
    elif args.command == "ingest":
        src, name = _source(spark, args)
        if src is None:
            out.update(source=name, rows=0)
        else:
            res = jobs.ingest(spark, store, src, name, overlap=args.overlap, fix_upper_bound=False)
            out.update(source=name, lo=res.lo, hi=res.hi, rows=res.rows)
    elif args.command == "refresh":
        res = incremental.refresh(spark, store, state_partitions=args.state_partitions,
                                  max_files=args.max_files, with_quarantine=args.quarantine,
                                  on_rules_change="reset" if args.reset_on_rule_change else
                                  "replay" if args.replay_on_rule_change else "error")
        out.update(batches=res.batches, quality=res.quality, reset=res.reset)
        _repoint_views(spark, store, args.schema, out)
    elif args.command == "rebuild":
        res = jobs.rebuild(spark, store, with_quarantine=args.quarantine, partition_by=args.partition_by,
                           with_sketches=args.sketches)
        out.update(quality=res.quality, tables=res.tables)
        _repoint_views(spark, store, args.schema, out)
    elif args.command == "health":
        out["tables"] = [r.asDict() for r in store_health(store, HEALTH).collect()]
    elif args.command == "quality":
        runs = (quality_history(store.read(TABLES.refresh_log)).limit(args.last).collect()
                if store.exists(TABLES.refresh_log) else [])
        out["runs"] = [r.asDict() for r in runs]
    elif args.command == "views":
        out["views"] = register_views(spark, store, args.schema)
    return out


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(args.master, app=f"lossline-{args.command}", scale=args.scale)
    try:
        print(json.dumps(run(args, spark), default=str))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
