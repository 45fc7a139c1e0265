"""Command line: ``spark-submit -m barsmith <command> ...`` (or ``python -m barsmith``).

Commands
  run     staged NDJSON of one run -> features (Parquet, optional table) -> views
  stage   vendor payload files -> normalised bars staged as NDJSON for a run
  ingest  incremental (availableNow) streaming ingestion of staged files

The session comes from the environment (``spark-submit`` settings); the library
never sets a master. The run date defaults to today's UTC date.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys


def _session():
    from barsmith.session import ensure_checkpoint_dir, get_session

    spark = get_session("barsmith")
    ensure_checkpoint_dir(spark, local_fallback=False)
    return spark


def main(argv=None) -> int:
    today = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d")
    p = argparse.ArgumentParser(prog="barsmith")
    sub = p.add_subparsers(dest="cmd", required=True)

    r = sub.add_parser("run", help="features + sinks + views for one run")
    r.add_argument("--staged", required=True, help="root of staged NDJSON (run_date=)")
    r.add_argument("--out", required=True, help="Parquet output path for the feature table")
    r.add_argument("--run-date", default=today)
    r.add_argument("--table", default=None, help="also write this catalog table")
    r.add_argument("--table-format", default="parquet")
    r.add_argument("--as-of", default=None, help="views' reference date (default: newest bar)")

    s = sub.add_parser("stage", help="normalise vendor payloads and stage them")
    s.add_argument("--payloads", required=True)
    s.add_argument("--staged", required=True)
    s.add_argument("--run-date", default=today)
    s.add_argument("--lookback-days", type=int, default=365)
    s.add_argument("--tickers", default=None, help="comma-separated universe")
    s.add_argument("--multi-line", action="store_true", help="payload files are JSON arrays")

    i = sub.add_parser("ingest", help="stream newly staged files into a bar store")
    i.add_argument("--staged", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--checkpoint", required=True)

    a = p.parse_args(argv)
    spark = _session()
    if a.cmd == "run":
        from barsmith.plans.job import run_pipeline

        res = run_pipeline(spark, a.staged, a.out, a.run_date, table=a.table,
                           table_format=a.table_format, as_of=a.as_of)
        print(json.dumps({"rows": res["rows"], "metrics": res["metrics"], "path": res["path"]}))
    elif a.cmd == "stage":
        from barsmith.plans.job import utc_stamp
        from barsmith.sources import ndjson, vendor

        end = _dt.datetime.strptime(a.run_date, "%Y%m%d").date()
        start, end = vendor.request_window(end, a.lookback_days)
        bars = vendor.normalize(vendor.read_payloads(spark, a.payloads, multi_line=a.multi_line),
                                utc_stamp())
        bars = vendor.in_window(bars, start, end)
        tickers = a.tickers.split(",") if a.tickers else vendor.DEFAULT_TICKERS
        bars = vendor.in_universe(bars, tickers)
        ndjson.stage(bars, a.staged, a.run_date)
        # Manifest (one row per requested ticker) next to the staged files; the
        # leading underscore keeps it out of the bar scans.
        universe = spark.createDataFrame([(t,) for t in tickers], "ticker string")
        staged = ndjson.scan(spark, a.staged, a.run_date)
        m = vendor.manifest(universe, staged, run_date=a.run_date, start=start, end=end,
                            uri_root=a.staged)
        m.write.mode("overwrite").json(
            f"{a.staged.rstrip('/')}/_manifests/run_date={a.run_date}")
        print(json.dumps(vendor.manifest_summary(m).first().asDict(), default=str))
    elif a.cmd == "ingest":
        from barsmith.streaming.ingest import ingest_available

        ingest_available(spark, a.staged, a.out, a.checkpoint)
    return 0


if __name__ == "__main__":
    sys.exit(main())
