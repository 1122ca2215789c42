"""What an application leaves behind, and what its workers need."""

import os
import subprocess
import sys

from conftest import ROOT

CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from tidemark.session import build_session, materialise, scratch_dir, ship
spark = build_session(master="local[2]", spark__checkpoint__dir={shared!r}, spark__ui__showConsoleProgress="false")
stored = materialise(spark, spark.range(10), "kept")
spark.range(3).write.parquet(scratch_dir(spark, "other"))
ship(spark)
ship(spark)
def known(batches):
    import tidemark.sources.commits
    yield from batches
assert stored.mapInArrow(known, "id long").count() == 10
import os
print("FILES", sum(len(names) for _, _, names in os.walk({shared!r})))
{end}
"""


def run(tmp_path, end):
    env = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    code = CODE.format(root=ROOT, shared=str(tmp_path / "shared"), end=end)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return int(done.stdout.rpartition("FILES")[2].split()[0])


def test_scratch_files_go_with_the_application_and_workers_get_the_package(tmp_path):
    assert run(tmp_path, "spark.stop()") > 2
    assert not [name for _, _, names in os.walk(tmp_path / "shared") for name in names]
    # Without a stop, too.
    assert run(tmp_path, "") > 2
    assert not [name for _, _, names in os.walk(tmp_path / "shared") for name in names]
