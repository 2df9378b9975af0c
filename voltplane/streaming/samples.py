"""Streams of samples (t timestamp, card, segment, value): dwell sessions, framed statistics, min/max thinning, idempotent publishing."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DRIFT_OUT = "card string, n long, slope_ppm double, residual double"
DRIFT_STATE = "n long, st double, sv double, stt double, stv double, svv double, t0 double"


def fresh(samples: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Without samples that came before: the same card, segment and time within the watermark."""
    return samples.withWatermark("t", late).dropDuplicatesWithinWatermark(["card", "segment", "t"])


def frames(samples: DataFrame, size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Per card, segment and window: n, mean and RMS after the mean."""
    span = F.window("t", size, slide) if slide else F.window("t", size)
    out = samples.withWatermark("t", late).groupBy(span.alias("w"), "card", "segment").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("rms"))
    return out.select("card", "segment", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "mean", "rms")


def thinned(samples: DataFrame, size: str, late: str = "10 minutes") -> DataFrame:
    """Per card and window the least and the largest value with their times."""
    out = samples.withWatermark("t", late).groupBy(F.window("t", size).alias("w"), "card").agg(F.min(F.struct("value", "t")).alias("low"), F.max(F.struct("value", "t")).alias("high"))
    return out.select("card", F.col("w.start").alias("start"), *[F.col(f"{k}.{c}").alias(f"{k}_{c}") for k in ("low", "high") for c in ("value", "t")])


def dwells(samples: DataFrame, gap: str, late: str = "10 minutes") -> DataFrame:
    """Per card the stretches whose samples are less than `gap` apart."""
    out = samples.withWatermark("t", late).groupBy(F.session_window("t", gap).alias("w"), "card").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))
    return out.select("card", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "mean")


def _drift(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = list(state.get) if state.exists else [0, 0.0, 0.0, 0.0, 0.0, 0.0, None]
    for pdf in batches:
        t = pdf["t"].astype("int64").to_numpy() / 1e9 if str(pdf["t"].dtype).startswith("datetime64[ns") else pdf["t"].astype("datetime64[us]").astype("int64").to_numpy() / 1e6
        v = pdf["value"].to_numpy(float)
        if held[6] is None and len(t):
            held[6] = float(t.min())
        t = t - (held[6] or 0.0)
        for i, x in enumerate((len(t), t.sum(), v.sum(), (t * t).sum(), (t * v).sum(), (v * v).sum())):
            held[i] += x
    n, st, sv, stt, stv, svv, _ = held
    held[0] = int(n)
    state.update(tuple(held))
    det = n * stt - st * st
    slope = (n * stv - st * sv) / det if det > 0 else 0.0
    left = max(0.0, svv - sv * sv / n - slope * (stv - st * sv / n)) if n else 0.0
    yield pd.DataFrame({"card": [key[0]], "n": [int(n)], "slope_ppm": [slope * 1e6], "residual": [(left / n) ** 0.5 if n else 0.0]})


def drift(delays: DataFrame) -> DataFrame:
    """A straight line through each card's delays (t, card, value in seconds), kept as sums in state: its slope in ppm after each batch."""
    return delays.groupBy("card").applyInPandasWithState(_drift, DRIFT_OUT, DRIFT_STATE, "update", GroupStateTimeout.NoTimeout)


def publish(results: DataFrame, store, name: str, checkpoint: str) -> StreamingQuery:
    """Writes each batch's runs to a run-keyed table: a batch that is run again replaces its own rows only."""
    return results.writeStream.foreachBatch(lambda df, _: store.upsert(name, df)).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
