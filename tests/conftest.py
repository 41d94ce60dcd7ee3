import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gaugeline.session import build_session

    session = build_session(
        "gaugeline-tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    from gaugeline import Lake

    return Lake(spark, str(tmp_path / "lake"))


HEAD = ", T10, P20, T10, F30\n, boiler, pump, boiler, fan\n, degC, bar, degC, rpm\n"
ROWS = '2024/3/5 07:30:00,1,2,"a",4,\n2024/3/5 07:30:01,1,2,"a",4,\n'


@pytest.fixture
def folder(tmp_path):
    """Writes files below an input folder; text is encoded as UTF-8."""
    root = tmp_path / "in"
    root.mkdir()

    class Folder:
        path = str(root)

        @staticmethod
        def put(name, content):
            target = root / name
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(content if isinstance(content, bytes) else content.encode())
            return str(target)

    return Folder


def contents(spark, *files):
    """A ``(path, source_zip, content)`` DataFrame from ``(path, bytes or text)`` pairs."""
    rows = [(path, "", body if isinstance(body, bytes) else body.encode()) for path, body in files]
    return spark.createDataFrame(rows, "path string, source_zip string, content binary")


def readings(df):
    """Sorted list of (time text, value, id, name, unit)."""
    rows = [(str(r.Time), r.value, r.sensor_id, r.sensor_name, r.unit) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple("" if x is None else x for x in r))
