import os
import sys
from datetime import datetime, timedelta

import numpy as np
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from tallygrain.columns import transaction_schema
from tallygrain.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def transactions(spark):
    """100 transactions of 10 customers, one per day."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(100):
        rows.append(
            (
                f"T{i + 1}", f"B{i % 10}", f"A{i % 5}", f"S{i % 10}", f"C{i % 10}", "UGX", "256", f"P{i % 5}", f"Product{i % 10}",
                str(rng.choice(["airtime", "data", "bills", "tv"])), str(rng.choice(["web", "app", "ussd"])),
                round(float(rng.uniform(100, 10000)), 2), round(float(rng.uniform(100, 10000)), 2),
                datetime(2023, 1, 1) + timedelta(days=i), int(rng.integers(1, 5)), int(rng.random() < 0.05),
            )
        )
    return spark.createDataFrame(rows, transaction_schema())
