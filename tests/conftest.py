from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parcelwise.session import local_session, tuned

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = tuned(local_session("tests", 8, 4))
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def sales_rows(n: int = 300, seed: int = 7) -> list[dict]:
    """Sale records whose price depends on quality, area and group."""
    rng = random.Random(seed)
    groups = ["NAmes", "CollgCr", "OldTown", "Edwards", "Somerst"]
    rows = []
    for i in range(n):
        qual, area, group = rng.randint(1, 10), float(rng.randint(800, 3999)), rng.choice(groups)
        built = rng.randint(1950, 2009)
        rows.append({
            "PID": i, "Order": i + 1, "SalePrice": 40000.0 + 15000 * qual + 40 * area + 5000 * groups.index(group) + rng.gauss(0, 5000),
            "Overall Qual": qual, "Overall Cond": rng.randint(1, 10), "Gr Liv Area": area, "Year Built": built,
            "Year Remod/Add": built + rng.choice([0, 0, 5, 60]), "Yr Sold": rng.randint(2006, 2010), "Mo Sold": rng.randint(1, 12),
            "Total Bsmt SF": float(rng.randint(0, 2000)), "1st Flr SF": float(rng.randint(400, 2000)), "2nd Flr SF": float(rng.randint(0, 1200)),
            "Garage Cars": float(rng.randint(0, 3)), "Garage Area": float(rng.randint(0, 899)), "Full Bath": rng.randint(1, 3),
            "Half Bath": rng.randint(0, 1), "Bsmt Full Bath": float(rng.randint(0, 1)), "Bsmt Half Bath": 0.0, "Fireplaces": rng.randint(0, 2),
            "Lot Area": float(rng.randint(2000, 20000)), "Lot Frontage": rng.uniform(20, 150),
            "Pool Area": float(rng.randint(100, 500)) if rng.random() < 0.03 else 0.0,
            "MS Zoning": rng.choice(["RL", "RM", "FV"]), "Neighborhood": group, "Sale Condition": rng.choice(["Normal", "Abnorml"]),
            "Alley": "Grvl" if rng.random() < 0.1 else None,
        })
    return rows


SALES_SCHEMA = (
    "PID long, `Order` long, SalePrice double, `Overall Qual` int, `Overall Cond` int, `Gr Liv Area` double, `Year Built` int, "
    "`Year Remod/Add` int, `Yr Sold` int, `Mo Sold` int, `Total Bsmt SF` double, `1st Flr SF` double, `2nd Flr SF` double, "
    "`Garage Cars` double, `Garage Area` double, `Full Bath` int, `Half Bath` int, `Bsmt Full Bath` double, `Bsmt Half Bath` double, "
    "Fireplaces int, `Lot Area` double, `Lot Frontage` double, `Pool Area` double, `MS Zoning` string, Neighborhood string, "
    "`Sale Condition` string, Alley string"
)


@pytest.fixture(scope="session")
def sales(spark):
    rows = sales_rows()
    order = list(rows[0])
    return spark.createDataFrame([tuple(r[k] for k in order) for r in rows], SALES_SCHEMA).cache()
