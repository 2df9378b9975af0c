"""Segmented scans, sine sums and shared skews over the test tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import clocks, measurement_model, relaxation, relocation, scans, sines, skew
from .array_queries import recording
from .check_queries import SPECTRA_SQL, plate_spectra
from .registry import events, query, table
from .table_queries import DOUBLES_SQL

#: Cycles a sample of two tones, the filter's memory, and the trigger's levels.
RATES, MEMORY, HIGH, LOW = (5 / 64, 9 / 64), 0.8, 0.12, 0.06
#: A sample of the recording a row.
SAMPLES_SQL = "s AS (SELECT vec_id % 8 AS channel, vec_id // 8 * 64 + i - 1 AS n, w[i] AS x FROM x, (SELECT unnest(range(1, 65)) AS i))"


@query(
    "tone_dwell_scan",
    f"""WITH {DOUBLES_SQL}, {SAMPLES_SQL}, u AS (SELECT channel, tone, n, x * cos(2 * pi() * rate * n) AS re, -x * sin(2 * pi() * rate * n) AS im FROM s, (VALUES (0, {RATES[0]}::DOUBLE), (1, {RATES[1]}::DOUBLE)) t(tone, rate)),
    y AS (SELECT u.channel, u.tone, u.n + k AS n, 2 * sqrt(pow(sum({1 - MEMORY!r}::DOUBLE * pow({MEMORY}::DOUBLE, k) * re), 2) + pow(sum({1 - MEMORY!r}::DOUBLE * pow({MEMORY}::DOUBLE, k) * im), 2)) AS e FROM u, (SELECT unnest(range(180)) AS k) GROUP BY ALL), z AS (SELECT channel, max(n) AS z FROM s GROUP BY ALL),
    m AS (SELECT channel, tone, n, CASE WHEN e >= {HIGH} THEN 1 ELSE -1 END AS kind FROM y JOIN z USING (channel) WHERE n <= z AND (e >= {HIGH} OR e < {LOW})), c AS (SELECT *, coalesce(lag(kind) OVER (PARTITION BY channel, tone ORDER BY n), -1) AS was FROM m),
    d AS (SELECT channel, tone, kind, n, lead(n) OVER (PARTITION BY channel, tone ORDER BY n) AS o FROM c WHERE kind <> was)
    SELECT channel::VARCHAR AS channel, tone, n AS first_sample, coalesce(o - 1, z) AS last_sample FROM d JOIN z USING (channel) WHERE kind = 1""",
)
def tone_dwell_scan(spark, d):
    return scans.tone_dwells(recording(spark, d), list(RATES), MEMORY, HIGH, LOW).select("channel", "tone", "first_sample", "last_sample")


def solve_sql(keys: str, quantum: float) -> str:
    """The solution of the normal equations in the sums n, sc, ss, scc, sss, scs, sx, sxc, sxs, sxx of a table m."""
    return (
        f"k AS (SELECT {keys}, n, sc, ss, sx, scc - sc * sc / n AS cc, sss - ss * ss / n AS s2, scs - sc * ss / n AS cs, sxc - sx * sc / n AS xc, sxs - sx * ss / n AS xs, sxx - sx * sx / n AS xx FROM m), "
        "q AS (SELECT *, CASE WHEN n >= 4 AND cc * s2 - cs * cs > 1e-9 * n * n THEN cc * s2 - cs * cs END AS det FROM k), a AS (SELECT *, (xc * s2 - xs * cs) / det AS a, (xs * cc - xc * cs) / det AS b FROM q), "
        f"r AS (SELECT *, CASE WHEN det IS NOT NULL THEN greatest(0, xx - a * xc - b * xs) END AS rest FROM a), f AS (SELECT {keys}, n, a AS re, -b AS im, (sx - a * sc - b * ss) / n AS c, sqrt(rest / n) AS rms, sqrt((rest / (n - 3) + {quantum * quantum / 12}::DOUBLE) * (cc + s2) / det / 2) / sqrt(a * a + b * b) AS sigma_rel FROM r)"
    )


SUMS_SQL = "count(*) AS n, sum(c) AS sc, sum(s) AS ss, sum(c * c) AS scc, sum(s * s) AS sss, sum(c * s) AS scs, sum(v) AS sx, sum(v * c) AS sxc, sum(v * s) AS sxs, sum(v * v) AS sxx"


@query(
    "step_phasor_sums",
    f"""WITH {DOUBLES_SQL}, {SAMPLES_SQL}, t AS (SELECT tone, 5.3 + tone % 7 AS f, tone * 640 + 13 AS lo, tone * 640 + 600 AS hi FROM (SELECT DISTINCT vec_id // 80 AS tone FROM x)),
    y AS (SELECT channel, tone, f, x AS v, cos(2 * pi() * f / 64 * (n - lo)) AS c, sin(2 * pi() * f / 64 * (n - lo)) AS s FROM s JOIN t ON n // 640 = tone AND n BETWEEN lo AND hi), m AS (SELECT channel, tone, f, {SUMS_SQL} FROM y GROUP BY ALL), {solve_sql("channel, tone, f", 0)}
    SELECT channel::VARCHAR AS channel, tone, f::DOUBLE AS freq_hz, n, round(re, 8) AS re, round(im, 8) AS im, round(c, 8) AS "offset", round(rms, 8) AS rms, round(sigma_rel, 6) AS sigma_rel FROM f""",
)
def step_phasor_sums(spark, d):
    chunks = recording(spark, d)
    k = F.col("tone")
    tones = chunks.select("path", F.floor(F.col("first_sample") / 640).alias("tone")).distinct().select("path", "tone", (5.3 + k % 7).alias("freq_hz"), (k * 640 + 13).alias("first_sample"), (k * 640 + 600).alias("last_sample"))
    f = sines.solved(sines.sums_of_chunks(chunks, tones))
    return f.select("channel", "tone", "freq_hz", "n", *[F.round(c, 8).alias(c) for c in ("re", "im", "offset", "rms")], F.round("sigma_rel", 6).alias("sigma_rel"))


@query(
    "uneven_sine_fits",
    f"""WITH y0 AS (SELECT card, segment % 16 AS channel, value AS v, 2 * pi() * ((t_us / 3600000000.0::DOUBLE - segment % 16 * 0.05::DOUBLE) / 24 - floor((t_us / 3600000000.0::DOUBLE - segment % 16 * 0.05::DOUBLE) / 24)) AS turn FROM e WHERE value IS NOT NULL), y AS (SELECT card, channel, v, cos(turn) AS c, sin(turn) AS s FROM y0),
    m AS (SELECT card, channel, {SUMS_SQL} FROM y GROUP BY ALL), {solve_sql("card, channel", 0.01)}
    SELECT card, channel, n, round(re, 6) AS re, round(im, 6) AS im, round(c, 6) AS "offset", round(rms, 6) AS rms, round(sigma_rel, 5) AS sigma_rel FROM f""",
)
def uneven_sine_fits(spark, d):
    """Daily sines of events at their own instants, each channel read a little later than the one before; values are rounded to a hundredth."""
    e = events(spark, d).withColumn("channel", F.col("segment") % 16)
    days = (F.col("t_us") / 3_600_000_000 - F.col("channel") * 0.05) / 24
    f = sines.solved(sines.sums_of_rows(e, ["card", "channel"], "value", 2 * math.pi * (days - F.floor(days))), 0.01)
    return f.select("card", "channel", "n", *[F.round(c, 6).alias(c) for c in ("re", "im", "offset", "rms")], F.round("sigma_rel", 5).alias("sigma_rel"))


def skew_sums_sql(k: int, theta: str) -> str:
    """A round's sums over each card's spectra, turned by theta0 + theta1 * slot: a spectrum's residual and derivative without their part along a resistance."""
    dot = lambda a, b: f"sum({a}r * {b}r + {a}i * {b}i)"
    return (
        f"v{k} AS (SELECT card, segment, slot, cos(ph + w * ({theta})) AS rr, sin(ph + w * ({theta})) AS ri, -w * sin(ph + w * ({theta})) AS gr, w * cos(ph + w * ({theta})) AS gi, 1 / size AS br, 0 AS bi FROM q), "
        f"d{k} AS (SELECT card, segment, slot, count(*) AS n, {dot('b', 'b')} AS bb, {dot('r', 'b')} AS rb, {dot('g', 'b')} AS gb, {dot('r', 'r')} AS rr, {dot('g', 'r')} AS gr, {dot('g', 'g')} AS gg FROM v{k} GROUP BY ALL), "
        f"e{k} AS (SELECT card, sum(gg - gb * gb / bb) AS m00, sum((gg - gb * gb / bb) * slot) AS m01, sum((gg - gb * gb / bb) * slot * slot) AS m11, sum(gr - gb * rb / bb) AS g0, sum((gr - gb * rb / bb) * slot) AS g1, sum(rr - rb * rb / bb) AS cost, count(*) AS spectra, sum(n) AS points FROM d{k} GROUP BY card)"
    )


@query(
    "shared_skews",
    f"""WITH {SPECTRA_SQL}, q0 AS (SELECT segment % 5 AS card, segment, (segment // 5)::DOUBLE AS slot, 2 * pi() * freq_hz AS w, atan2(im, re) AS ph, sqrt(re * re + im * im) AS size, 0.0::DOUBLE AS t0, 0.0::DOUBLE AS t1 FROM s WHERE freq_hz > 0 AND abs(re) + abs(im) > 0),
    q AS (SELECT * FROM q0 QUALIFY count(*) OVER (PARTITION BY segment) > 3), {skew_sums_sql(0, "t0 + t1 * slot")}, t AS (SELECT card, cost AS c0, -(g0 * m11 - g1 * m01) / (m00 * m11 - m01 * m01) AS s0, -(g1 * m00 - g0 * m01) / (m00 * m11 - m01 * m01) AS s1 FROM e0),
    {skew_sums_sql(1, "(SELECT s0 FROM t WHERE t.card = q.card) + (SELECT s1 FROM t WHERE t.card = q.card) * slot")}
    SELECT card, round(CASE WHEN e1.cost <= c0 THEN s0 ELSE 0 END, 9) AS common_s, round(CASE WHEN e1.cost <= c0 THEN s1 ELSE 0 END, 9) AS slot_s, round(c0, 6) AS cost_before, round(least(e1.cost, c0), 6) AS cost, e1.spectra AS n_spectra FROM e1 JOIN t USING (card)""",
)
def shared_skews(spark, d):
    points = plate_spectra(spark, d).select((F.col("segment") % 5).alias("card"), "segment", F.floor(F.col("segment") / 5).cast("double").alias("slot"), F.lit(1.0).alias("one"), "freq_hz", "re", "im")
    # one step, as the spectra of this table are no delayed ones
    fit = skew.shared_skew(skew.assembled(points, ["card", "segment"], kept=["one", "slot"]), ["card"], ["one", "slot"], per_decade=None, rounds=1)
    return fit.select("card", F.round(F.col("theta")[0], 9).alias("common_s"), F.round(F.col("theta")[1], 9).alias("slot_s"), F.round("cost_before", 6).alias("cost_before"), F.round("cost", 6).alias("cost"), "n_spectra")


#: By how many samples copies of a record are laid late.
LATE = {"late": 9, "early": -4, "far": 320}


@query(
    "card_clocks",
    """SELECT * FROM (VALUES ('late', 9.0::DOUBLE, 0.0::DOUBLE, true), ('early', -4.0::DOUBLE, 0.0::DOUBLE, true), ('far', NULL, NULL, false)) t(card, offset_samples, rate_ppm, ok) WHERE (SELECT count(*) FROM embeddings) > 0""",
)
def card_clocks(spark, d):
    """All vectors end to end as a record, against copies of it that begin later or earlier; one is off by more than is searched, and so has nothing in common with it."""
    record = table(spark, d, "embeddings").select((F.col("vec_id") * 64).alias("first_sample"), F.col("embedding").alias("samples"))
    copies = F.explode(F.array(F.struct(F.lit("ref").alias("card"), F.lit(0).alias("late")), *[F.struct(F.lit(c).alias("card"), F.lit(k).alias("late")) for c, k in LATE.items()]))
    rows = record.withColumn("_c", copies).select("_c.card", (F.col("first_sample") + F.col("_c.late")).alias("first_sample"), "samples")
    found = clocks.card_clocks(rows, "ref", 64.0, (1.0, 28.0), block=1 << 12, search=32, frame=256)
    return found.select("card", F.round(F.col("offset_s") * 64, 3).alias("offset_samples"), (F.round("rate_ppm", 1) + 0.0).alias("rate_ppm"), "ok")


#: Cycles a sample of three tones, the lock-in window, and the least size of a peak.
TONES, WINDOW, LEAST = (5 / 64, 9 / 64, 13 / 64), 128, 0.03


@query(
    "lock_in_peaks",
    f"""WITH {DOUBLES_SQL}, {SAMPLES_SQL}, u AS (SELECT channel, tone, n, x * cos(2 * pi() * rate * n) AS re, -x * sin(2 * pi() * rate * n) AS im FROM s, (VALUES {", ".join(f"({i}, {r!r}::DOUBLE)" for i, r in enumerate(TONES))}) t(tone, rate)),
    y AS (SELECT channel, tone, n, sum(re) OVER w AS re, sum(im) OVER w AS im, count(*) OVER w AS m FROM u WINDOW w AS (PARTITION BY channel, tone ORDER BY n ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
    z AS (SELECT channel, tone, n, 2.0::DOUBLE / {WINDOW} * sqrt(re * re + im * im) AS size FROM y WHERE m = {WINDOW}),
    k AS (SELECT *, max(size) OVER (PARTITION BY channel, tone ORDER BY n ROWS BETWEEN {WINDOW // 2} PRECEDING AND {WINDOW // 2} FOLLOWING) AS top FROM z)
    SELECT a.channel::VARCHAR AS channel, a.tone, a.n AS "at", round(a.size, 7) AS size, round(a.size / max(b.top), 6) AS dominance FROM k a JOIN k b ON a.channel = b.channel AND a.n = b.n AND a.tone <> b.tone WHERE a.size >= {LEAST} AND a.size = a.top GROUP BY a.channel, a.tone, a.n, a.size""",
)
def lock_in_peaks(spark, d):
    found = relocation.lock_in_peaks(recording(spark, d), list(TONES), WINDOW, LEAST, block=1 << 12)
    return found.select("channel", "tone", "at", F.round("size", 7).alias("size"), F.round("dominance", 6).alias("dominance"))


@query("relocated_entries")
def relocated_entries(spark, d):
    """For each channel a log of one entry each ten chunks, of the three tones in turn, found again in it."""
    chunks = recording(spark, d).select(F.col("channel").alias("path"), "channel", "first_sample", "samples")
    peaks = relocation.lock_in_peaks(chunks, list(TONES), WINDOW, LEAST, block=1 << 12)
    entries = chunks.select("path", F.floor(F.col("first_sample") / 640).alias("entry")).distinct()
    entries = entries.select("path", "entry", (F.col("entry") % 3).cast("int").alias("tone"), (F.col("entry") * 640).alias("expected"), F.lit(WINDOW).alias("gap"))
    found = relocation.relocated(entries, peaks, 2000.0)
    return found.select("path", "entry", "tone", "at", F.round("size", 7).alias("size"), F.round("score", 6).alias("score"))


@query("relaxation_bands")
def relaxation_bands(spark, d):
    """The plate's mean spectra with bands of their resistances."""
    points = plate_spectra(spark, d).where("freq_hz > 0")
    out = relaxation.relaxation_bands(skew.assembled(points, ["segment"]), ["segment"], sigma_rel=0.1, per_decade=3, samples=100)
    return out.select("segment", *[F.round(c, 3).alias(c) for c in ("noise", "series", "series_low", "series_high", "polarisation", "polarisation_low", "polarisation_high")])


@query("measurement_models")
def measurement_models(spark, d):
    """The plate's mean spectra as series resistances and as many relaxations as they bear, without the points that don't fit."""
    spectra = skew.assembled(plate_spectra(spark, d).where("freq_hz > 0"), ["segment"])
    out = measurement_model.measurement_models(spectra, ["segment"], sigma_rel=0.1)
    return out.select("segment", "order", F.round(F.col("resistances")[0], 4).alias("series"), F.round("chi_square", 4).alias("chi_square"), F.size("removed").alias("n_removed"))
