import os
import subprocess
import sys
from pathlib import Path

from ledgersift.session import ensure_checkpoint_dir, work_folder

ROOT = Path(__file__).resolve().parent.parent

ELSEWHERE = """
import sys
sys.path.insert(0, {root!r})
from ledgersift.session import get_session
from ledgersift.operators.oversample import smote
spark = get_session("elsewhere", "2")
rows = spark.createDataFrame([(i % 4 == 0, float(i), float(i * i % 13)) for i in range(40)],
                             "fraud boolean, a double, b double")
assert smote(rows, ["a", "b"], "fraud").count() == 60
print("made")
"""


def test_work_lies_in_the_configured_folder_or_the_warehouse(spark):
    folder = ensure_checkpoint_dir(spark)
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    assert folder in (spark.conf.get("spark.checkpoint.dir", None),
                      spark.sparkContext.getCheckpointDir()) or folder.startswith(warehouse)
    one, two = work_folder(spark, "x"), work_folder(spark, "x")
    assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
    assert spark.sparkContext.applicationId in one


def test_no_machine_local_folder_in_the_package():
    for path in (ROOT / "ledgersift").rglob("*.py"):
        text = path.read_text()
        assert "tempfile" not in text and "localCheckpoint" not in text, path


def test_python_functions_reach_workers_without_the_package(tmp_path):
    """Run from another folder, with a path that only the driver knows."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", ELSEWHERE.format(root=str(ROOT))], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=300)
    assert "made" in done.stdout, done.stderr[-2000:]
