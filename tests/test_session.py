"""Session helpers: shared folder and cluster sizing."""

from flotilla.session import cluster_settings, fresh_path, shared_dir


def test_shared_dir_from_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == base
    a, b = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert a != b and a.startswith(base)


def test_cluster_settings_scale():
    conf = cluster_settings(100 * 1024 ** 4, 16_000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409_600
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)
    small = cluster_settings(10 * 1024 ** 2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24


def test_shared_dir_when_session_names_none(tmp_path):
    """A session without spark.checkpoint.dir (no defaults file): a folder is
    created once and registered with the context; the config is not set."""
    import os
    import subprocess
    import sys
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[1]').getOrCreate()\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "from flotilla.session import shared_dir, cut_lineage\n"
        "a, b = shared_dir(s), shared_dir(s)\n"
        "assert a == b and a in s.sparkContext.getCheckpointDir()\n"
        "assert cut_lineage(s.range(3)).count() == 3\n"
        "print('OK')\n" % os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = dict(os.environ, SPARK_CONF_DIR=str(tmp_path))
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=240)
    assert out.stdout.strip().endswith("OK"), out.stderr[-2000:]
