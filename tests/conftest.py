from __future__ import annotations

import json
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from starweave.session import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = spark_session(
        "tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__sql__maxMetadataStringLength="10000",
        spark__sql__debug__maxToStringFields="1000",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__checkpoint__dir=str(folder / "checkpoints"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write(tmp_path):
    """Write text to a file and return its path."""

    def _write(name: str, text: str) -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(path)

    return _write


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def event_log(tmp_path):
    """Run lines of code in a session of its own and return the events that it logged.

    The code sees ``spark`` and ``folder``, a scratch folder.
    """

    def _events(code: str) -> list[dict]:
        log = tmp_path / f"events-{len(list(tmp_path.glob('events-*')))}"
        log.mkdir()
        head = f"""
            import sys
            sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
            from starweave.session import spark_session
            folder = {str(log)!r} + "/work"
            spark = spark_session(
                "events", spark__master="local[4]", spark__sql__shuffle__partitions="4",
                spark__eventLog__enabled="true", spark__eventLog__compress="false", spark__eventLog__dir={str(log)!r},
                spark__checkpoint__dir=folder, spark__sql__warehouse__dir=folder + "/warehouse",
                spark__ui__showConsoleProgress="false")
            """
        script = textwrap.dedent(head) + textwrap.dedent(code) + "\nspark.stop()\n"
        done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
        files = [f for f in log.rglob("*") if f.is_file() and "work" not in f.relative_to(log).parts]
        lines = [line for f in files for line in f.read_text().splitlines() if line.startswith("{")]
        return [json.loads(line) for line in lines]

    return _events
