"""The command line (S13): stage vendor payloads, then run the batch job."""

import json
import os
import subprocess
import sys

from conftest import ROOT

# Two vendor records for one instrument.
RECORDS = [
    {"date": "2024-01-15T00:00:00+00:00", "open": 180.0, "high": 185.0, "low": 178.0,
     "close": 183.0, "volume": 55000000, "adjOpen": 180.0, "adjHigh": 185.0,
     "adjLow": 178.0, "adjClose": 183.0, "adjVolume": 55000000},
    {"date": "2024-01-16T00:00:00+00:00", "open": 183.0, "high": 186.0, "low": 181.0,
     "close": 182.0, "volume": 41000000, "adjOpen": 183.0, "adjHigh": 186.0,
     "adjLow": 181.0, "adjClose": 182.0, "adjVolume": 41000000},
]


def _cli(*args, shared=None, **more):
    conf = f"--conf spark.checkpoint.dir={shared} " if shared else ""
    env = dict(os.environ, PYTHONPATH=ROOT,
               PYSPARK_SUBMIT_ARGS=f"--master local[2] --conf spark.ui.enabled=false {conf}pyspark-shell", **more)
    return subprocess.run([sys.executable, "-m", "barsmith", *args], cwd=ROOT, env=env,
                          capture_output=True, text=True, timeout=600)


def test_stage_then_run(tmp_dir):
    os.makedirs(f"{tmp_dir}/payloads")
    with open(f"{tmp_dir}/payloads/aapl.json", "w") as f:
        json.dump(RECORDS, f)
    st = _cli("stage", "--payloads", f"{tmp_dir}/payloads", "--staged", f"{tmp_dir}/staged",
              "--run-date", "20240131", "--multi-line", "--tickers", "AAPL,MSFT", shared=f"{tmp_dir}/ck")
    assert st.returncode == 0, st.stderr[-2000:]
    assert os.path.isdir(f"{tmp_dir}/staged/run_date=20240131")
    summary = json.loads(st.stdout.strip().splitlines()[-1])
    assert (summary["succeeded"], summary["failed"], summary["rows"]) == (1, 1, 2)
    assert os.path.isdir(f"{tmp_dir}/staged/_manifests/run_date=20240131")
    run = _cli("run", "--staged", f"{tmp_dir}/staged", "--out", f"{tmp_dir}/out",
               "--run-date", "20240131", shared=f"{tmp_dir}/ck")
    assert run.returncode == 0, run.stderr[-2000:]
    summary = json.loads(run.stdout.strip().splitlines()[-1])
    assert summary["rows"] == 2 and summary["metrics"]["null_adj_close"] == 0
    # one run's folder; beside it the ledger that commits it and the state it leaves
    assert sorted(os.listdir(f"{tmp_dir}/out")) == ["_ledger", "_state", "run_date=20240131"]


def test_refuses_to_run_without_a_shared_folder(tmp_dir):
    run = _cli("ingest", "--staged", tmp_dir, "--out", f"{tmp_dir}/out", "--checkpoint", f"{tmp_dir}/ck",
               SPARK_CONF_DIR=tmp_dir)  # no defaults that name a folder
    assert run.returncode != 0 and "spark.checkpoint.dir" in run.stderr


def test_submitted_settings_survive():
    code = ("from barsmith.session import get_session; s = get_session();"
            "print(s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'))")
    env = dict(os.environ, PYTHONPATH=ROOT, PYSPARK_SUBMIT_ARGS="--master local[1] --conf spark.ui.enabled=false "
               "--conf spark.sql.shuffle.partitions=5000 pyspark-shell")
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.split() == ["5000", "UTC"], out.stderr[-1000:]
