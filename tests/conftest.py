import gzip
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

HEADER = "ticker,volume,open,close,high,low,window_start,transactions"
DAY_NANOS = 86_400_000_000_000


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw_zone(tmp_path):
    """Writes day files: raw_zone("2024-01-02", lines, header=...)."""

    def write(day, lines, header=HEADER, root="raw"):
        folder = tmp_path / root / f"year={day[:4]}" / f"month={day[5:7]}"
        folder.mkdir(parents=True, exist_ok=True)
        file = folder / f"{day}.csv.gz"
        with gzip.open(file, "wt", encoding="utf-8", newline="") as out:
            out.write("".join(f"{line}\n" for line in ([header] if header else []) + list(lines)))
        return str(file)

    write.root = str(tmp_path / "raw")
    write.path = tmp_path
    return write


def nanos(day, offset=0):
    """Epoch nanoseconds of the start of a day, plus an offset."""
    import datetime as dt

    days = (dt.date.fromisoformat(day) - dt.date(1970, 1, 1)).days
    return days * DAY_NANOS + offset


def line(ticker, day, volume="100", price="1.0", high="3.0", low="0.5", offset=0, transactions="1"):
    return f"{ticker},{volume},{price},{price},{high},{low},{nanos(day, offset)},{transactions}"


@pytest.fixture
def table_name():
    import uuid

    return f"t_{uuid.uuid4().hex}"
