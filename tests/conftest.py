import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "jobs"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    b = (SparkSession.builder.master("local[4]")
         .appName("eligo-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")   # list local files without a job
         .config("spark.sql.adaptive.enabled", "true"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):   # set only where unset
        d = tempfile.mkdtemp(prefix="eligo-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="eligo-test-")
