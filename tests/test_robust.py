"""Robust statistics to the last bit."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from voltplane import plans


@pytest.mark.parametrize("odd", [False, True])
def test_neighbour_drop_at_its_limit(spark, tmp_path, odd):
    """Values in cents meet the limit exactly, so its last bit decides; odd: with missing and infinite values."""
    rng = np.random.default_rng(5)
    n = 40_000
    user = np.arange(n) // 2 % (n // 20)
    value = (user % 97 * 53 + rng.integers(0, 9, n) + 4000 * (rng.random(n) < 0.8)) / 100
    value = pd.array(value, dtype="Float64")
    if odd:
        value[rng.random(n) < 0.3] = pd.NA
        value[rng.random(n) < 0.05] = np.inf
    e = pd.DataFrame({"event_id": np.arange(n), "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n) // 3, "s"), "user_id": user, "event_type": "view", "value": value, "props": "{}"})
    path = str(tmp_path / "events.parquet")
    db = duckdb.connect()
    db.sql(f"COPY (SELECT * REPLACE (ts::TIMESTAMP AS ts) FROM e) TO '{path}'")
    db.sql(f"CREATE VIEW events AS SELECT * FROM '{path}'")
    want = sorted(db.sql(plans.SQL["neighbour_p75_drop"]).fetchall())
    got = sorted(map(tuple, plans.QUERIES["neighbour_p75_drop"](spark, str(tmp_path)).select("event_id", "level").collect()))
    assert len(want) > 1000 and got == want
