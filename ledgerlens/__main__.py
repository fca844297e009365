"""Command line for the two jobs.

    python -m ledgerlens reconcile --ledger PATH --second PATH --out DIR [--second-format csv]
        [--tolerances config.ini | --percent 5 --levenshtein 1 --seconds 300] [--multi]
    python -m ledgerlens aggregates --clean DIR --out DIR [--calculation-ts "2024-01-31 00:00:00"]

Inputs are Parquet (or a headerless CSV copy for the second source, or a JDBC
table with ``--ledger-jdbc URL TABLE``, which ``--jdbc-split COLUMN LOW HIGH
PARTS`` reads in parallel ranges). ``--jdbc-properties`` names a file of
``key=value`` lines (driver, user, password ...), so that no credentials appear
on the command line. ``--append-jdbc URL TABLE`` appends the clean rows or, for
aggregates, this calculation's sums (TABLE is the prefix of ``_daily``,
``_monthly``, ``_total``) to database tables as well. The cluster launcher
provides the master; ``spark.checkpoint.dir`` names the shared folder for scratch
tables; ``--input-bytes`` and ``--total-cores`` size the shuffles.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from ledgerlens.config import Tolerances
from ledgerlens.plans import jobs
from ledgerlens.schemas import LEDGER, SECOND_SOURCE
from ledgerlens.session import build_session
from ledgerlens.sources import files, jdbc


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m ledgerlens")
    sub = p.add_subparsers(dest="command", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--input-bytes", type=int, help="size of the input, to size shuffles (with --total-cores)")
    common.add_argument("--total-cores", type=int, help="cores of the cluster")
    common.add_argument("--jdbc-properties", help="file of key=value lines for JDBC reads and appends")
    common.add_argument("--append-jdbc", nargs=2, metavar=("URL", "TABLE"), help="append the results to database tables too")
    common.add_argument("--append-connections", type=int, help="most connections of an append")

    r = sub.add_parser("reconcile", parents=[common], help="pair two sources, write the pairs report and the clean rows")
    src = r.add_mutually_exclusive_group(required=True)
    src.add_argument("--ledger", help="Parquet path of the first source (ledger table)")
    src.add_argument("--ledger-jdbc", nargs=2, metavar=("URL", "TABLE"), help="JDBC URL and table of the ledger")
    r.add_argument("--jdbc-split", nargs=4, metavar=("COLUMN", "LOW", "HIGH", "PARTS"), help="read the ledger in ranges of a column")
    r.add_argument("--null-token", help="text that stands for NULL in row hashes")
    r.add_argument("--second", required=True, help="path of the second source")
    r.add_argument("--second-format", choices=("parquet", "csv"), default="parquet")
    r.add_argument("--out", required=True)
    r.add_argument("--tolerances", help="INI file with a [tolerance_vars] section")
    r.add_argument("--percent", type=float)
    r.add_argument("--levenshtein", type=int)
    r.add_argument("--seconds", type=int)
    r.add_argument("--char-inclusive", action="store_true")
    r.add_argument("--symmetric-time", action="store_true")
    r.add_argument("--multi", action="store_true", help="emit a pair once per accepting rule")

    a = sub.add_parser("aggregates", parents=[common], help="add daily, monthly and total signed sums to the history")
    a.add_argument("--clean", required=True, help="clean table written by `reconcile`")
    a.add_argument("--out", required=True)
    a.add_argument("--calculation-ts", help="calculation time (default: now, UTC)")
    return p


def _tolerances(args: argparse.Namespace) -> Tolerances:
    flags = {"char_inclusive": args.char_inclusive, "symmetric_time": args.symmetric_time}
    if args.tolerances:
        return Tolerances.from_ini(args.tolerances, **flags)
    values = {}
    if args.percent is not None:
        values["tolerance_percent"] = repr(args.percent)
    if args.levenshtein is not None:
        values["tolerance_levenshtein"] = str(args.levenshtein)
    if args.seconds is not None:
        values["tolerance_seconds"] = str(args.seconds)
    return Tolerances.from_mapping(values, **flags)


def jdbc_properties(path: str | None) -> dict[str, str]:
    """``key=value`` lines of a file (blank lines and # comments are skipped)."""
    if not path:
        return {}
    with open(path) as lines:
        pairs = [line.strip().partition("=") for line in lines if line.strip() and not line.lstrip().startswith("#")]
    return {key.strip(): value.strip() for key, _, value in pairs}


def jdbc_split(values: list[str] | None) -> dict[str, str | int]:
    """Arguments of a range-split JDBC read."""
    if not values:
        return {}
    column, low, high, parts = values
    return {"partition_column": column, "lower_bound": low, "upper_bound": high, "num_partitions": int(parts)}


def _append(args: argparse.Namespace, frames: dict) -> None:
    """Append result frames to database tables (name suffix -> frame)."""
    if args.append_jdbc:
        url, table = args.append_jdbc
        for suffix, df in frames.items():
            jdbc.append_table(df, url, table + suffix, jdbc_properties(args.jdbc_properties), num_partitions=args.append_connections)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if bool(args.input_bytes) != bool(args.total_cores):
        _parser().error("--input-bytes and --total-cores go together")
    spark = build_session(app_name=f"ledgerlens-{args.command}", input_bytes=args.input_bytes, total_cores=args.total_cores)
    if args.command == "reconcile":
        if args.ledger:
            ledger = files.read_parquet(spark, args.ledger, LEDGER)
        else:
            url, table = args.ledger_jdbc
            ledger = jdbc.read_table(spark, url, table, jdbc_properties(args.jdbc_properties), **jdbc_split(args.jdbc_split))
        if args.second_format == "csv":
            second = files.read_source_csv(spark, args.second)
        else:
            second = files.read_parquet(spark, args.second, SECOND_SOURCE)
        out = jobs.reconcile(spark, ledger, second, args.out, _tolerances(args), multi=args.multi, null_token=args.null_token)
        _append(args, {"": jobs.read_clean(spark, out.clean)})
        print(json.dumps({"pairs": out.pairs, "clean": out.clean}))
    else:
        calc = dt.datetime.fromisoformat(args.calculation_ts) if args.calculation_ts else None
        out = jobs.aggregates(spark, jobs.read_clean(spark, args.clean), args.out, calc)
        if args.append_jdbc:
            _append(args, {f"_{n}": jobs.read_calculation(spark, path, out.calc_id).drop("calc_id")
                           for n, path in (("daily", out.daily), ("monthly", out.monthly), ("total", out.total))})
        print(json.dumps({"daily": out.daily, "monthly": out.monthly, "total": out.total,
                          "calculation_ts": out.calculation_ts.isoformat(sep=" ")}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
