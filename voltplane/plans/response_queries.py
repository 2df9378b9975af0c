"""Responses of chains and cards, lags, agreed schedules and filled spectra over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import impedance
from ..operators import joins, numeric, response, signal
from .check_queries import SPECTRA_SQL, plate_spectra
from .registry import events, points, query, rounded, table
from .table_queries import ADJACENT_SQL, DOUBLES_SQL, PADS_SQL, pads, sums_sql, windows_of

#: Responses of a chain a card: one at the points' areas, one at their frequencies.
RESPONSES_SQL = "n AS (SELECT card, area * 1.7 AS f, 1 + avg(thd) AS h FROM p GROUP BY ALL), o AS (SELECT card, freq_hz AS f, 1 + avg(snr_db) / 1000 AS h FROM p WHERE freq_hz > 0 GROUP BY ALL)"


def responses(spark, d):
    p = points(spark, d)
    new = p.groupBy("card", (F.col("area") * 1.7).alias("f")).agg((1 + F.avg("thd")).alias("h"))
    return new, p.where("freq_hz > 0").groupBy("card", F.col("freq_hz").alias("f")).agg((1 + F.avg("snr_db") / 1000).alias("h"))


def read_sql(grid: str, known: str, x: str, out: str) -> str:
    """Interpolation over ln x within a card, held beyond the ends."""
    return (
        f"{out}0 AS (SELECT g.*, k.{x} AS x0, k.h AS h0 FROM {grid} g ASOF LEFT JOIN {known} k ON g.card = k.card AND g.{x} >= k.{x}), "
        f"{out}1 AS (SELECT b.*, k.{x} AS x1, k.h AS h1 FROM {out}0 b ASOF LEFT JOIN {known} k ON b.card = k.card AND b.{x} <= k.{x}), "
        f"{out} AS (SELECT card, {x}, CASE WHEN x0 IS NULL THEN h1 WHEN x1 IS NULL THEN h0 WHEN x1 > x0 THEN h0 + (h1 - h0) * (ln({x}) - ln(x0)) / (ln(x1) - ln(x0)) ELSE h0 END AS h FROM {out}1)"
    )


@query(
    "relative_response",
    """WITH m AS (SELECT card, freq_hz, median(sqrt(z_re * z_re + z_im * z_im)) AS m FROM p GROUP BY ALL), l AS (SELECT card, median(m) AS l FROM m WHERE freq_hz BETWEEN 10 AND 40 GROUP BY card), r AS (SELECT card, freq_hz, m / l AS y, freq_hz / 42 - 1 AS x FROM m JOIN l USING (card)),
    s AS (SELECT card, count(*) AS a, sum(x) AS b, sum(x * x) AS c, sum(x * x * x) AS d, sum(x * x * x * x) AS e, sum(y) AS t, sum(x * y) AS u, sum(x * x * y) AS v FROM r GROUP BY card),
    k AS (SELECT card, a * (c * e - d * d) - b * (b * e - d * c) + c * (b * d - c * c) AS w, t * (c * e - d * d) - b * (u * e - d * v) + c * (u * d - c * v) AS k0, a * (u * e - d * v) - t * (b * e - d * c) + c * (b * v - u * c) AS k1, a * (c * v - u * d) - b * (b * v - u * c) + t * (b * d - c * c) AS k2 FROM s)
    SELECT card, freq_hz, round(y, 6) AS response, round((k0 + k1 * x + k2 * x * x) / w, 6) AS smooth FROM r JOIN k USING (card)""",
)
def relative_response(spark, d):
    sizes = points(spark, d).withColumn("size", impedance.magnitude((F.col("z_re"), F.col("z_im"))))
    return rounded(response.relative_response(sizes, "card", "freq_hz", "size", 10, 40, 42))


@query(
    "response_applied",
    f"""WITH {RESPONSES_SQL}, s AS (SELECT card, freq_hz AS f, avg(z_re) AS z FROM p WHERE freq_hz > 0 GROUP BY ALL), k AS (SELECT s.card, s.f, s.z, arg_min(n.h, (round(abs(ln(s.f / n.f)), 12), n.f)) AS h FROM s JOIN n ON s.card = n.card GROUP BY ALL)
    SELECT card, f, round(CASE WHEN f >= 20 THEN z / h ELSE z END, 6) AS z FROM k""",
)
def response_applied(spark, d):
    new, _ = responses(spark, d)
    s = points(spark, d).where("freq_hz > 0").groupBy("card", F.col("freq_hz").alias("f")).agg(F.avg("z_re").alias("z"))
    out = response.nearest_step(s, new, ["card"], "f", ["h"])
    return out.select("card", "f", F.round(F.when(F.col("f") >= 20, F.col("z") / F.col("h")).otherwise(F.col("z")), 6).alias("z"))


@query(
    "composed_response",
    f"""WITH {RESPONSES_SQL}, g AS (SELECT card, f FROM n UNION ALL SELECT card, f FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.card = o.card AND abs(ln(n.f / o.f)) <= 0.005)),
    {read_sql("g", "n", "f", "a")}, {read_sql("g", "o", "f", "b")} SELECT a.card, round(a.f, 6) AS f, round(a.h * b.h, 9) AS h FROM a JOIN b ON a.card = b.card AND a.f = b.f""",
)
def composed_response(spark, d):
    out = response.composed(*responses(spark, d), ["card"], "f", "h")
    return out.select("card", F.round("f", 6).alias("f"), F.round("h", 9).alias("h"))


@query(
    "held_out_cards",
    """WITH m AS (SELECT card, freq_hz, median(z_re) AS v FROM p GROUP BY ALL), r AS (SELECT a.card, a.freq_hz, a.v, median(b.v) AS m FROM m a JOIN m b ON a.freq_hz = b.freq_hz AND a.card <> b.card GROUP BY ALL)
    SELECT card, count(*) AS n, round(median(100 * (v / m - 1)), 6) AS deviation_pct, round(max(abs(100 * (v / m - 1))), 6) AS worst_pct FROM r GROUP BY card""",
)
def held_out_cards(spark, d):
    return rounded(response.held_out(points(spark, d).groupBy("card", "freq_hz").agg(F.median("z_re").alias("v")), "card", "freq_hz", "v"))


def lag_round_sql(k: int) -> str:
    return (
        f"m{k} AS (SELECT f, median(ph + w * tau) AS m FROM q{k} GROUP BY f), t{k} AS (SELECT segment, max(tau) - sum(w * (ph + w * tau - m)) / sum(w * w) AS tau, count(*) AS n FROM q{k} JOIN m{k} USING (f) GROUP BY segment), "
        f"c{k} AS (SELECT segment, tau - (SELECT median(tau) FROM t{k}) AS tau, n FROM t{k}), q{k + 1} AS (SELECT segment, f, ph, w, c{k}.tau FROM q0 JOIN c{k} USING (segment))"
    )


@query(
    "channel_lags",
    f"""WITH {SPECTRA_SQL}, q0 AS (SELECT segment, freq_hz AS f, atan2(im, re) AS ph, 2 * pi() * freq_hz AS w, 0.0::DOUBLE AS tau FROM s WHERE freq_hz > 0), {", ".join(map(lag_round_sql, range(3)))}
    SELECT segment, n, round(1e6 * tau, 4) AS tau_us, CASE WHEN n < 4 THEN 'few' WHEN abs(tau) > 2e-4 THEN 'large' ELSE 'ok' END AS status FROM c2""",
)
def channel_lags(spark, d):
    phases = plate_spectra(spark, d).where("freq_hz > 0").select("segment", "freq_hz", F.atan2("im", "re").alias("ph"))
    out = response.channel_lags(phases, "segment", "freq_hz", "ph", 2e-4)
    return out.select("segment", "n", F.round(1e6 * F.col("tau"), 4).alias("tau_us"), "status")


LAGS_SQL = ", ".join(f"{{'c': round(list_dot_product(u.w[4:61], v.w[{4 + k}:{61 + k}]), 9), 'k': {-k}}}" for k in range(-3, 4))


@query(
    "blockwise_lags",
    f"""WITH {DOUBLES_SQL}, l AS (SELECT u.label, u.vec_id, -list_max([{LAGS_SQL}]).k AS lag FROM x u JOIN x v ON v.vec_id = u.vec_id + 1)
    SELECT label, count(*) AS n_blocks, CAST(min(lag) AS BIGINT) AS least, CAST(max(lag) AS BIGINT) AS most, round(1e6 * regr_slope(lag, vec_id * 64), 6) AS drift_ppm FROM l GROUP BY label""",
)
def blockwise_lags(spark, d):
    x = windows_of(spark, d)
    pairs = x.join(x.select((F.col("vec_id") - 1).alias("vec_id"), F.col("w").alias("y")), "vec_id").withColumn("lag", response.window_lag(F.col("w"), F.col("y"), 64, 3))
    return rounded(pairs.groupBy("label").agg(F.count(F.lit(1)).alias("n_blocks"), F.min("lag").cast("long").alias("least"), F.max("lag").cast("long").alias("most"), (1e6 * F.regr_slope("lag", F.col("vec_id") * 64)).alias("drift_ppm")))


STEPS_SQL = "d AS (SELECT o_orderpriority AS plate, o_custkey % 5 AS card, (year(o_orderdate) - 1992) * 12 + month(o_orderdate) AS k, min(epoch(o_orderdate) / 86400.0) AS start, max(epoch(o_orderdate) / 86400.0) AS stop FROM orders GROUP BY ALL), f AS (SELECT *, pow(1.1, k) * (1 + 0.001 * card) AS f FROM d)"


def dwells(spark, d):
    """Orders of a month as a card's dwell at one frequency, which cards measure slightly differently."""
    day = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)") / 86400.0
    k = (F.year("o_orderdate") - 1992) * 12 + F.month("o_orderdate")
    o = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("plate"), (F.col("o_custkey") % 5).alias("card"), k.alias("k")).agg(F.min(day).alias("start"), F.max(day).alias("stop"))
    return o.withColumn("f", F.pow(F.lit(1.1), "k") * (1 + 0.001 * F.col("card")))


@query(
    "consensus_schedule",
    f"""WITH {STEPS_SQL}, c AS (SELECT *, CASE WHEN f > 1.01 * lag(f) OVER (PARTITION BY plate ORDER BY f) THEN 1 ELSE 0 END AS fresh FROM f), g AS (SELECT *, sum(fresh) OVER (PARTITION BY plate ORDER BY f) AS step FROM c)
    SELECT plate, CAST(step AS BIGINT) AS step, round(median(f), 6) AS f, round(median(start), 6) AS start, round(median(stop), 6) AS stop, count(DISTINCT card) AS n_cards, count(DISTINCT card) >= 3 AS agreed FROM g GROUP BY plate, step""",
)
def consensus_schedule(spark, d):
    return rounded(response.consensus(dwells(spark, d), ["plate"], "card", "f", "start", "stop"))


@query(
    "snapped_schedule",
    f"""WITH {STEPS_SQL}, t AS (SELECT plate, p, sum(cos(2 * pi() * p * log10(f))) AS c, sum(sin(2 * pi() * p * log10(f))) AS s, count(*) AS n FROM f, range(5, 26) r(p) GROUP BY plate, p),
    b AS (SELECT plate, arg_max({{'p': p, 'o': atan2(s, c) / (2 * pi())}}, (round(sqrt(c * c + s * s) / n, 9), -p)) AS b FROM t GROUP BY plate),
    k AS (SELECT plate, card, f, b.p AS p, pow(10.0, (round(b.p * log10(f) - b.o) + b.o) / b.p) AS rung FROM f JOIN b USING (plate))
    SELECT plate, card, round(f, 6) AS f, CAST(p AS INTEGER) AS per_decade, round(rung, 6) AS snapped, round(100 * (f / rung - 1), 6) AS off_pct FROM k""",
)
def snapped_schedule(spark, d):
    return rounded(response.snapped(dwells(spark, d), ["plate"], "f", list(range(5, 26))).select("plate", "card", "f", "per_decade", "snapped", "off_pct"))


@query("collapsed_windows")
def collapsed_windows(spark, d):
    """Dwells that overlap by more than half, or share a frequency: the one of the higher level stays. Order dependent, so it has no SQL; see the test."""
    level = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("plate"), (F.col("o_custkey") % 5).alias("card"), ((F.year("o_orderdate") - 1992) * 12 + F.month("o_orderdate")).alias("k")).agg(F.max("o_totalprice").alias("snr"))
    steps = dwells(spark, d).join(level, ["plate", "card", "k"]).select("plate", "k", "card", "f", F.col("start") - 10, "stop", "snr").toDF("plate", "k", "card", "f", "start", "stop", "snr")

    def keep(g):
        return g[numeric.kept_windows(*(g[c].to_numpy(float) for c in ("f", "start", "stop", "snr")))]

    # the steps of a schedule: some hundred rows a plate, whatever the number of samples
    return steps.groupBy("plate").applyInPandas(keep, steps.schema)


def power_sql(k) -> str:
    c, s = sums_sql(k)
    return f"(pow({c}, 2) + pow({s}, 2))"


@query(
    "tone_occupancy",
    f"""WITH {DOUBLES_SQL}, q AS (SELECT label, vec_id, unnest([{", ".join(f"{{'k': {k}, 'p': {power_sql(k)}}}" for k in range(1, 17))}]) AS u FROM x), m AS (SELECT vec_id, median(u.p) AS m FROM q GROUP BY vec_id)
    SELECT label, u.k AS tone, round(avg(CASE WHEN 10 * log10(u.p / m) > 6 THEN 1.0 ELSE 0.0 END), 9) AS occupancy, count(*) AS n_frames FROM q JOIN m USING (vec_id) GROUP BY ALL""",
)
def tone_occupancy(spark, d):
    powers = []
    for k in range(1, 17):
        c, s = signal.dft(F.col("w"), k)
        powers.append(c * c + s * s)
    return rounded(response.occupancy(windows_of(spark, d), "label", "vec_id", F.array(*powers), 6.0), 9)


@query(
    "background_level",
    f"""WITH {DOUBLES_SQL}, q AS (SELECT label, vec_id // 4 AS stretch, 4 * {power_sql(8)} / 4096 AS own, ({" + ".join(power_sql(k) for k in (3, 5, 11, 13))}) / 4096 AS off FROM x)
    SELECT label, stretch, count(*) AS n_windows, round(sqrt(greatest(0, avg(own) - avg(off))), 6) AS background FROM q GROUP BY ALL""",
)
def background_level(spark, d):
    """Coherent amplitude at 8 cycles a window over the mean of the bins 3 and 5 beside it, in stretches of four windows."""
    return rounded(signal.background(windows_of(spark, d), ["label", F.floor(F.col("vec_id") / 4).alias("stretch")], "w", 8, 64, (3, 5)))


@query(
    "plate_temperatures",
    f"""WITH k AS (SELECT s_nationkey AS card, exp(1 + s_suppkey % 45) AS f, avg(s_acctbal / 80 + 20) AS h FROM supplier WHERE s_acctbal / 80 + 20 > 0 AND s_acctbal / 80 + 20 < 120 GROUP BY ALL),
    g AS (SELECT n_nationkey AS card, c AS x, exp(3 + 5 * c) AS f FROM nation, range(0, 9) r(c)), {read_sql("g", "k", "f", "a")}
    SELECT card AS plate, CAST(x AS INTEGER) AS x, round(coalesce(a.h, 65.0), 6) AS celsius, a.h IS NULL AS fallback FROM g JOIN a USING (card, f)""",
)
def plate_temperatures(spark, d):
    """Sensors within 0 to 120 degrees, linear along the plate between them, to nine columns of segments; 65 degrees where a plate has none."""
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("card"), F.exp((1 + F.col("s_suppkey") % 45).cast("double")).alias("f"), (F.col("s_acctbal") / 80 + 20).alias("t"))
    known = s.where("t > 0 AND t < 120").groupBy("card", "f").agg(F.avg("t").alias("h"))
    grid = table(spark, d, "nation").select(F.col("n_nationkey").alias("card"), F.explode(F.array(*map(F.lit, range(9)))).alias("x")).withColumn("f", F.exp((3 + 5 * F.col("x")).cast("double")))
    # linear in x is linear in the logarithm of exp(x)
    out = joins.interpolate_log(known, grid, ["card"], "f", ["h"])
    return out.select(F.col("card").alias("plate"), "x", F.round(F.coalesce("h", F.lit(65.0)), 6).alias("celsius"), F.col("h").isNull().alias("fallback"))


@query(
    "filled_spectra",
    f"""WITH {PADS_SQL}, {ADJACENT_SQL}, {SPECTRA_SQL}, v AS (SELECT segment, avg(p_size) AS v FROM pads GROUP BY segment), m AS (SELECT median(v) AS m FROM v), have AS (SELECT segment FROM v, m WHERE v.v >= m.m), want AS (SELECT segment FROM v, m WHERE v.v < m.m),
    one AS (SELECT w.segment, a.neighbour AS spot, 1 AS hops FROM want w JOIN adj a USING (segment)), two AS (SELECT DISTINCT o.segment, a.neighbour AS spot, 2 AS hops FROM one o JOIN adj a ON o.spot = a.segment WHERE a.neighbour <> o.segment AND NOT EXISTS (SELECT 1 FROM one q WHERE q.segment = o.segment AND q.spot = a.neighbour)),
    r AS (SELECT k.segment, spot AS donor, hops FROM (SELECT * FROM one UNION ALL SELECT * FROM two) k JOIN have h ON k.spot = h.segment), dn AS (SELECT segment, donor FROM r WHERE hops = (SELECT min(q.hops) FROM r q WHERE q.segment = r.segment)),
    z AS (SELECT * FROM s WHERE freq_hz > 0), sp AS (SELECT segment AS donor, round(max(freq_hz) / min(freq_hz), 9) AS span, count(*) AS n FROM z GROUP BY segment), wd AS (SELECT segment, arg_max(donor, (span, n, -donor)) AS grid FROM dn JOIN sp USING (donor) GROUP BY segment),
    wn AS (SELECT wd.segment, dn.donor AS card, z.freq_hz AS f FROM wd JOIN z ON z.segment = wd.grid JOIN dn ON dn.segment = wd.segment), g AS (SELECT DISTINCT card, f FROM wn), kr AS (SELECT segment AS card, freq_hz AS f, re AS h FROM z), ki AS (SELECT segment AS card, freq_hz AS f, im AS h FROM z),
    {read_sql("g", "kr", "f", "a")}, {read_sql("g", "ki", "f", "b")}
    SELECT wn.segment, f AS freq_hz, round(sum((1 + card % 5) * a.h) / sum(1 + card % 5), 6) AS re, round(sum((1 + card % 5) * b.h) / sum(1 + card % 5), 6) AS im, count(*) AS n_donors FROM wn JOIN a USING (card, f) JOIN b USING (card, f) GROUP BY ALL""",
)
def filled_spectra(spark, d):
    """Segments whose mean lies below the plate's median are filled from the first ring of others within two hops."""
    p = pads(spark, d)
    v = p.groupBy("segment").agg(F.avg("p_size").alias("v"))
    # one row
    rated = v.join(F.broadcast(v.agg(F.median("v").alias("m"))))
    donors = joins.donor_ring(rated.where("v < m").select("segment"), joins.adjacency(p), rated.where("v >= m").select("segment"))
    areas = v.select("segment", (1 + F.col("segment") % 5).alias("area"))
    return rounded(response.filled(plate_spectra(spark, d).where("freq_hz > 0"), donors, areas))


@query("values_scan", "SELECT card AS file_id, segment AS channel, count(*) AS n, round(sum(value), 4) AS total, min(t_us) AS first_us FROM e WHERE card IN ('click', 'view') AND segment IN (1, 2, 3, 5, 8, 13, 21, 34) GROUP BY ALL")
def values_scan(spark, d):
    e = events(spark, d).where(F.col("card").isin("click", "view") & F.col("segment").isin(1, 2, 3, 5, 8, 13, 21, 34))
    return e.groupBy(F.col("card").alias("file_id"), F.col("segment").alias("channel")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), F.min("t_us").alias("first_us"))


@query(
    "attached_fits",
    "WITH f AS (SELECT segment, round(regr_slope(z_re, area), 6) AS slope FROM p WHERE flag = 'R' GROUP BY segment) SELECT s_suppkey AS segment, s_nationkey AS plate, slope, slope IS NOT NULL AS fitted FROM supplier LEFT JOIN f ON segment = s_suppkey",
)
def attached_fits(spark, d):
    fits = points(spark, d).where("flag = 'R'").groupBy("segment").agg(F.round(F.regr_slope("z_re", "area"), 6).alias("slope"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("segment"), F.col("s_nationkey").alias("plate"))
    return s.join(fits, "segment", "left").select("segment", "plate", "slope", F.col("slope").isNotNull().alias("fitted"))


@query(
    "concat_conditions",
    "SELECT condition, count(*) AS n, round(avg(v), 6) AS mean FROM (SELECT 'A' AS condition, z_re AS v FROM p WHERE flag = 'A' UNION ALL SELECT 'R', z_re FROM p WHERE flag = 'R' UNION ALL SELECT 'open', value FROM e WHERE card = 'view') GROUP BY condition",
)
def concat_conditions(spark, d):
    p = points(spark, d)
    frames = [p.where(F.col("flag") == c).select(F.lit(c).alias("condition"), F.col("z_re").alias("v")) for c in ("A", "R")]
    frames.append(events(spark, d).where("card = 'view'").select(F.lit("open").alias("condition"), F.col("value").alias("v")))
    whole = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return rounded(whole.groupBy("condition").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean")))
