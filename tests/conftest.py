import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from brambling.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # blocks stay apart, so that what crosses them is tested on small frames
    session = local_session(4, partitions=4, **{
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.driver.memory": "6g",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def walk(spark):
    """Random bars of three series, one of them with most of the rows."""
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(7)
    parts = []
    for symbol, n in (("hot", 400), ("b", 60), ("c", 9)):
        price = np.round(50 * np.exp(np.cumsum(rng.normal(0, .03, n))), 2)
        parts.append(pd.DataFrame({"symbol": symbol, "open_time": pd.date_range("2024-01-01", periods=n, freq="h"), "price": price}))
    pdf = pd.concat(parts, ignore_index=True)
    frame = spark.createDataFrame(pdf.sample(frac=1, random_state=1), "symbol string, open_time timestamp_ntz, price double")
    return pdf, frame
