"""The spark-submit entry runs the same jobs and queries."""

from __future__ import annotations

from conftest import SF0001

from cartwheel.__main__ import main


def test_cli_job_and_query(spark, tmp_path):
    status = main(["job", "build_customer_360_sp", "--data", SF0001])
    assert status.startswith("SUCCESS: Saved ") and status.endswith(" rows to analytics.customer_360")
    out = tmp_path / "rbr"
    assert main(["query", "revenue_by_region", "--data", SF0001, "--out", str(out)]) == \
        f"wrote revenue_by_region to {out}"
    assert spark.read.parquet(str(out)).count() == 5


def test_input_bytes_counts_the_data_dir(spark):
    from cartwheel.__main__ import input_bytes
    assert input_bytes(spark, SF0001) > 0


def _submit(tmp_path, *conf, script, args=()):
    import os
    import shutil
    import subprocess
    import sys

    import pyspark
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(str(tmp_path / "cartwheel"), "zip", root, "cartwheel")
    command = [os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit"), "--master", "local[2]",
               "--py-files", archive, "--conf", "spark.ui.enabled=false",
               "--conf", f"spark.sql.warehouse.dir={tmp_path}/warehouse"]
    for c in conf:
        command += ["--conf", c]
    env = {**os.environ, "PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1"}
    done = subprocess.run([*command, script, *args], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_documented_submit_command(tmp_path):
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = _submit(tmp_path, script=os.path.join(root, "submit.py"),
                  args=["query", "revenue_by_region", "--data", SF0001, "--out", str(tmp_path / "out")])
    assert "wrote revenue_by_region" in out


def test_submitted_settings_win(tmp_path):
    script = tmp_path / "show.py"
    script.write_text(
        "from cartwheel.__main__ import _session\n"
        f"s = _session(False, {SF0001!r})\n"
        "for k in ('advisoryPartitionSizeInBytes', 'forceOptimizeSkewedJoin', 'skewJoin.enabled'):\n"
        "    print('GOT', s.conf.get('spark.sql.adaptive.' + k))\n")
    out = _submit(tmp_path, "spark.sql.adaptive.advisoryPartitionSizeInBytes=64m",
                  "spark.sql.adaptive.forceOptimizeSkewedJoin=false", script=str(script))
    assert [x.split()[1] for x in out.splitlines() if x.startswith("GOT")] == ["64m", "false", "true"]


def test_cluster_needs_a_given_warehouse(monkeypatch, spark):
    import pytest

    from cartwheel import session

    class Conf:
        def __init__(self, given):
            self.given = given

        def contains(self, key):
            return self.given

    class Fake:
        def __init__(self, master, given):
            self.sparkContext = type("C", (), {"master": master, "getConf": lambda _: Conf(given)})()
            self.conf = type("K", (), {"get": lambda _, key: "file:/home/me/spark-warehouse"})()

    for master in ("yarn", "local-cluster[2,1,512]", "spark://host:7077"):
        with pytest.raises(RuntimeError):
            session.output_root(Fake(master, False))
        assert session.output_root(Fake(master, True))
    assert session.output_root(Fake("local[4]", False))
