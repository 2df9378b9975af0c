"""Repairs, plausibility checks, calibrations and framed statistics over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import impedance, text
from ..operators import checks, joins, robust, signal
from ..streaming import samples
from .registry import events, points, query, rounded, table
from .table_queries import ADJACENT_SQL, DOUBLES_SQL, PADS_SQL, pads, windows_of

#: A plate of 36 segments, as the pads have it.
SPECTRA_SQL = "s AS (SELECT segment % 36 AS segment, freq_hz, avg(z_re) AS re, avg(z_im) AS im FROM p GROUP BY ALL)"


def plate_spectra(spark, d):
    return points(spark, d).groupBy((F.col("segment") % 36).alias("segment"), "freq_hz").agg(F.avg("z_re").alias("re"), F.avg("z_im").alias("im"))


@query(
    "polarity_sign",
    """WITH q AS (SELECT segment, z_re - 42 AS re, snr_db, greatest(0.1, least(30, snr_db)) AS w FROM p),
    s AS (SELECT segment, count(*) FILTER (WHERE snr_db >= 36) AS good, count(*) AS n, sum(w) AS w, sum(CASE WHEN re < 0 THEN w ELSE 0 END) AS neg, sum(CASE WHEN snr_db >= 36 THEN w ELSE 0 END) AS wg, sum(CASE WHEN snr_db >= 36 AND re < 0 THEN w ELSE 0 END) AS negg FROM q GROUP BY segment),
    r AS (SELECT segment, CASE WHEN good >= 3 THEN good ELSE n END AS n_used, CASE WHEN good >= 3 THEN negg / wg ELSE neg / w END AS part FROM s)
    SELECT segment, n_used, round(part, 6) AS negative_share, CASE WHEN part > 0.6 THEN -1 ELSE 1 END AS sign FROM r""",
)
def polarity_sign(spark, d):
    return rounded(checks.polarity(points(spark, d).withColumn("re", F.col("z_re") - 42), "segment", "re", "snr_db", least_snr=36))


@query(
    "passivity_check",
    """WITH w AS (SELECT card, segment, bool_or(z_re - 1 <= 0) AS bad, min(z_re - 1) AS least FROM p GROUP BY ALL)
    SELECT card, count(*) AS n_segments, count(*) FILTER (WHERE bad) AS n_failing, round(min(least), 6) AS worst, CASE WHEN bool_or(bad) THEN 'fail' ELSE 'pass' END AS verdict FROM w GROUP BY card""",
)
def passivity_check(spark, d):
    return rounded(checks.passivity(points(spark, d).withColumn("re", F.col("z_re") - 1), "card", "segment", "re"))


@query(
    "dc_share_faults",
    f"""WITH {PADS_SQL}, {ADJACENT_SQL}, v AS (SELECT segment, avg(p_size) AS v FROM pads GROUP BY segment), r AS (SELECT a.segment, median(b.v) AS m, count(*) AS n FROM adj a JOIN v b ON a.neighbour = b.segment GROUP BY a.segment),
    q AS (SELECT v.segment, v / m AS share, coalesce(n, 0) AS n FROM v LEFT JOIN r ON v.segment = r.segment)
    SELECT segment, round(share, 6) AS share, n AS n_ring, CASE WHEN n < 2 THEN '' WHEN share < 0.97 THEN 'low' WHEN share > 1 / 0.97 THEN 'high' ELSE '' END AS reason FROM q""",
)
def dc_share_faults(spark, d):
    p = pads(spark, d)
    return rounded(checks.share_faults(p.groupBy("segment").agg(F.avg("p_size").alias("v")), joins.adjacency(p), "v", 0.97))


@query(
    "transfer_imputed",
    """WITH c AS (SELECT c_custkey AS segment, CASE WHEN c_acctbal >= 0 THEN 1 + c_acctbal / 1e4 END AS c0, CASE WHEN c_nationkey <> 7 THEN c_nationkey / 10.0 END AS c1 FROM customer),
    m AS (SELECT median(c0) AS m0, median(c1) AS m1 FROM c)
    SELECT segment, round(coalesce(c0, m0) + 1e-3 * coalesce(c1, m1) * 65.0, 9) AS k, (c0 IS NULL OR c1 IS NULL) AS imputed FROM c, m""",
)
def transfer_imputed(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("segment"), F.when(F.col("c_acctbal") >= 0, 1 + F.col("c_acctbal") / 1e4).alias("c0"), F.when(F.col("c_nationkey") != 7, F.col("c_nationkey") / 10.0).alias("c1"))
    return checks.imputed(c, ["c0", "c1"]).select("segment", F.round(impedance.shunt_sensitivity(F.col("c0"), F.col("c1"), F.lit(65.0)), 9).alias("k"), "imputed")


@query(
    "off_ladder_pruned",
    """WITH f AS (SELECT DISTINCT o_totalprice / 100 AS f FROM orders), k AS (SELECT f, round(ln(f / 5) / ln(1.2589254117941673)) AS k FROM f WHERE f > 0)
    SELECT round(f, 6) AS freq_hz, CAST(k AS BIGINT) AS rung, round(abs(f / (5 * pow(1.2589254117941673, k)) - 1), 6) AS off, abs(f / (5 * pow(1.2589254117941673, k)) - 1) <= 0.02 AS on_ladder FROM k""",
)
def off_ladder_pruned(spark, d):
    k, off = checks.rung(F.col("f"), 5.0, 10**0.1)
    return table(spark, d, "orders").select((F.col("o_totalprice") / 100).alias("f")).distinct().where("f > 0").select(F.round("f", 6).alias("freq_hz"), k.alias("rung"), F.round(off, 6).alias("off"), (off <= 0.02).alias("on_ladder"))


@query(
    "verdict_counts_check",
    """WITH v AS (SELECT s_nationkey AS card, CASE WHEN s_acctbal > -900 THEN s_acctbal / 5000 - 1 END AS off FROM supplier),
    c AS (SELECT card, count(*) FILTER (WHERE abs(off) <= 0.5) AS n_good, count(*) FILTER (WHERE abs(off) > 0.5 AND abs(off) <= 0.9) AS n_doubtful, count(*) FILTER (WHERE abs(off) > 0.9) AS n_bad, count(*) FILTER (WHERE off IS NULL) AS n_unknown FROM v GROUP BY card)
    SELECT *, CASE WHEN n_good + n_doubtful + n_bad = 0 THEN 'unknown' WHEN n_bad > 0.1 * (n_good + n_doubtful + n_bad) THEN 'fail' WHEN n_bad + n_doubtful > 0 THEN 'warn' ELSE 'pass' END AS status FROM c""",
)
def verdict_counts_check(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("card"), F.when(F.col("s_acctbal") > -900, F.col("s_acctbal") / 5000 - 1).alias("off"))
    return checks.banded_check(s, ["card"], F.col("off"), 0.5, 0.9)


@query(
    "card_alignment_check",
    """WITH m AS (SELECT card, median(value) AS m FROM e GROUP BY card), o AS (SELECT e.card, value - m AS off FROM e JOIN m USING (card)),
    c AS (SELECT card, count(*) FILTER (WHERE abs(off) <= 40) AS n_good, count(*) FILTER (WHERE abs(off) > 40 AND abs(off) <= 150) AS n_doubtful, count(*) FILTER (WHERE abs(off) > 150) AS n_bad, count(*) FILTER (WHERE off IS NULL) AS n_unknown FROM o GROUP BY card)
    SELECT *, CASE WHEN n_good + n_doubtful + n_bad = 0 THEN 'unknown' WHEN n_bad > 0.1 * (n_good + n_doubtful + n_bad) THEN 'fail' WHEN n_bad + n_doubtful > 0 THEN 'warn' ELSE 'pass' END AS status FROM c""",
)
def card_alignment_check(spark, d):
    e = events(spark, d)
    # few cards hold all rows, so their medians are taken by rank
    middle = robust.quantiles(e, ["card"], "value", [0.5]).select("card", F.col("quantile").alias("m"))
    off = e.join(middle, "card").withColumn("off", F.col("value") - F.col("m"))
    return checks.banded_check(off, ["card"], F.col("off"), 40, 150)


@query(
    "step_validity",
    """WITH s AS (SELECT card, freq_hz, snr_db >= 8 AND thd <= 0.06 AND abs(z_im / 50 - 0.2) <= 1 AND greatest(1e-3, least(1.0, sqrt(1 / (area * pow(10.0, snr_db / 10))))) <= 0.01 AS ok FROM p WHERE area >= 1)
    SELECT card, freq_hz, count(*) FILTER (WHERE ok) AS n_valid, count(*) AS n FROM s GROUP BY ALL""",
)
def step_validity(spark, d):
    sigma = signal.sigma_from_snr(F.col("snr_db"), F.col("area"))
    ok = (F.col("snr_db") >= 8) & (F.col("thd") <= 0.06) & (F.abs(F.col("z_im") / 50 - 0.2) <= 1) & (sigma <= 0.01)
    return points(spark, d).where("area >= 1").groupBy("card", "freq_hz").agg(F.count_if(ok).alias("n_valid"), F.count(F.lit(1)).alias("n"))


@query(
    "process_split",
    f"""WITH {DOUBLES_SQL}, t AS (SELECT vec_id, list_transform(w, lambda g, i: {{'g': g, 't': -4.0 + 6.0 * (i - 1) / len(w)}}) AS q, 6.0 / len(w) AS step FROM x),
    m AS (SELECT vec_id, step * list_sum(list_transform(q, lambda v: CASE WHEN v.t >= -4 AND v.t < -2 THEN v.g ELSE 0 END)) AS fast, step * list_sum(list_transform(q, lambda v: CASE WHEN v.t >= -2 AND v.t < 0 THEN v.g ELSE 0 END)) AS mid,
    step * list_sum(list_transform(q, lambda v: CASE WHEN v.t >= 0 AND v.t < 2 THEN v.g ELSE 0 END)) AS slow FROM t)
    SELECT vec_id, CASE WHEN fast >= 0 THEN round(fast, 6) END AS fast, CASE WHEN mid >= 0 THEN round(mid, 6) END AS mid, CASE WHEN slow >= 0 THEN round(slow, 6) END AS slow FROM m""",
)
def process_split(spark, d):
    n = F.size("w")
    places = F.transform(F.sequence(F.lit(0), n - 1), lambda i: -4.0 + 6.0 * i / n)
    return rounded(windows_of(spark, d).select("vec_id", *checks.band_masses(F.col("w"), places, 6.0 / n, [-4.0, -2.0, 0.0, 2.0], ["fast", "mid", "slow"])))


NAME_SQL = "CASE p_size % 3 WHEN 0 THEN 'Plate_' || p_partkey WHEN 1 THEN 'Plate_GEN' || (p_size % 4) || '_' || p_partkey ELSE 'cell-gen' || (p_size % 4) || '_order' || (p_size % 7) END"


@query(
    "name_predicates",
    f"""WITH n AS (SELECT p_partkey, {NAME_SQL} AS name FROM part)
    SELECT p_partkey, CASE WHEN regexp_extract(name, '([Gg][Ee][Nn][0-9])', 1) = '' THEN NULL ELSE lower(regexp_extract(name, '([Gg][Ee][Nn][0-9])', 1)) = 'gen1' END AS names_version,
    CASE WHEN regexp_extract(name, 'order([0-9]+)', 1) = '' THEN NULL ELSE regexp_extract(name, 'order([0-9]+)', 1) = '3' END AS names_order FROM n""",
)
def name_predicates(spark, d):
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    gen = (size % 4).cast("string")
    name = F.when(size % 3 == 0, F.concat(F.lit("Plate_"), key)).when(size % 3 == 1, F.concat(F.lit("Plate_GEN"), gen, F.lit("_"), key)).otherwise(F.concat(F.lit("cell-gen"), gen, F.lit("_order"), (size % 7).cast("string")))
    return table(spark, d, "part").select("p_partkey", checks.says(name, "([Gg][Ee][Nn][0-9])", F.lit("gen1")).alias("names_version"), checks.says(name, "order([0-9]+)", F.lit("3")).alias("names_order"))


@query(
    "card_gain_verdicts",
    """WITH c AS (SELECT card, freq_hz, avg(z_re) AS re, avg(z_im) AS im, avg(snr_db) AS snr FROM p GROUP BY ALL), h AS (SELECT card, freq_hz, sqrt(re * re + im * im) AS s, atan2(im, re) AS a FROM c WHERE freq_hz BETWEEN 1 AND 300 AND snr >= 10),
    r AS (SELECT freq_hz, median(s) AS m, atan2(sum(sin(a)), sum(cos(a))) AS a0 FROM h GROUP BY freq_hz), q AS (SELECT card, s / m AS ratio, atan2(sin(a - a0), cos(a - a0)) AS turned FROM h JOIN r USING (freq_hz)),
    g AS (SELECT card, count(*) AS n_steps, median(ratio) AS gain, stddev_pop(ratio) / avg(ratio) AS spread, median(turned) AS turned FROM q GROUP BY card)
    SELECT card, n_steps, round(gain, 6) AS gain, round(spread, 6) AS spread, round(turned, 6) AS turned, CASE WHEN abs(gain - 1) <= 0.001 THEN 'agrees' WHEN spread <= 0.05 THEN 'gain' ELSE 'shape' END AS verdict, NOT abs(gain - 1) <= 0.001 AND spread <= 0.05 AS correctable FROM g""",
)
def card_gain_verdicts(spark, d):
    c = points(spark, d).groupBy("card", "freq_hz").agg(F.avg("z_re").alias("re"), F.avg("z_im").alias("im"), F.avg("snr_db").alias("snr"))
    h = c.withColumn("s", F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))).withColumn("a", F.atan2("im", "re"))
    usable = F.col("freq_hz").between(1, 300) & (F.col("snr") >= 10)
    return rounded(checks.gain_verdicts(checks.card_ratios(h, "card", "freq_hz", "s", "a", usable), "card", good=0.001))


@query("sense_offset", "SELECT o_orderpriority AS plate, round(regr_slope(o_totalprice, o_custkey), 6) AS slope, round(regr_intercept(o_totalprice, o_custkey), 4) AS intercept, round(regr_r2(o_totalprice, o_custkey), 9) AS r2, count(*) AS n FROM orders GROUP BY plate")
def sense_offset(spark, d):
    y, x = "o_totalprice", "o_custkey"
    return table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("plate")).agg(F.round(F.regr_slope(y, x), 6).alias("slope"), F.round(F.regr_intercept(y, x), 4).alias("intercept"), F.round(F.regr_r2(y, x), 9).alias("r2"), F.count(F.lit(1)).alias("n"))


@query("card_residual", "WITH c AS (SELECT freq_hz, card, median(z_re) AS m FROM p GROUP BY ALL), a AS (SELECT freq_hz, median(m) AS all_m FROM c GROUP BY freq_hz) SELECT freq_hz, card, round(100 * (m / all_m - 1), 6) AS residual_pct FROM c JOIN a USING (freq_hz)")
def card_residual(spark, d):
    c = points(spark, d).groupBy("freq_hz", "card").agg(F.median("z_re").alias("m"))
    return c.join(c.groupBy("freq_hz").agg(F.median("m").alias("all_m")), "freq_hz").select("freq_hz", "card", F.round(100 * (F.col("m") / F.col("all_m") - 1), 6).alias("residual_pct"))


@query(
    "implied_area",
    """WITH r AS (SELECT l_suppkey AS segment, l_extendedprice / l_quantity / (1 + l_discount) AS r FROM lineitem), a AS (SELECT segment, median(r) AS area, stddev_pop(r) / avg(r) AS cv FROM r GROUP BY segment),
    m AS (SELECT median(area) AS m FROM a), s AS (SELECT median(abs(area - m)) AS s FROM a, m) SELECT segment, round(area, 6) AS area, round(cv, 6) AS cv, abs(area - m) > 2 * s AS outlier FROM a, m, s""",
)
def implied_area(spark, d):
    return rounded(checks.implied_area(table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "segment"), "segment", F.col("l_extendedprice") / F.col("l_quantity") / (1 + F.col("l_discount")), 2.0))


@query(
    "calibration_linearity",
    """WITH l AS (SELECT l_suppkey AS segment, regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b, max(l_extendedprice) - min(l_extendedprice) AS span FROM lineitem GROUP BY l_suppkey),
    f AS (SELECT segment, a, span, max(abs(l_extendedprice - a * l_quantity - b)) AS far FROM lineitem JOIN l ON segment = l_suppkey GROUP BY ALL), m AS (SELECT median(a) AS m FROM f)
    SELECT segment, round(a, 6) AS slope, round(100 * far / CASE WHEN span > 0 THEN span END, 6) AS linearity_pct, round(100 * (a / m - 1), 6) AS deviation_pct FROM f, m""",
)
def calibration_linearity(spark, d):
    out = checks.linearity(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("segment"), "l_quantity", "l_extendedprice"), "segment", "l_quantity", "l_extendedprice")
    # one row
    middle = F.broadcast(out.agg(F.median("slope").alias("m")))
    return rounded(out.join(middle).select("segment", "slope", "linearity_pct", (100 * (F.col("slope") / F.col("m") - 1)).alias("deviation_pct")))


@query(
    "peak_prominence",
    f"""WITH {DOUBLES_SQL}, u AS (SELECT vec_id, unnest(list_transform(w, lambda v, i: {{'k': i - 1, 'v': v}})) AS q FROM x), y AS (SELECT vec_id, q.k AS k, q.v AS v FROM u), t AS (SELECT vec_id, max(v) AS high, arg_max(k, (v, -k)) AS top FROM y GROUP BY vec_id),
    f AS (SELECT y.*, high, top FROM y JOIN t USING (vec_id) WHERE abs(k - top) > 3), m AS (SELECT vec_id, median(v) AS m FROM f GROUP BY vec_id), s AS (SELECT f.vec_id, median(abs(v - m)) AS s FROM f JOIN m USING (vec_id) GROUP BY f.vec_id)
    SELECT vec_id, CAST(top AS INTEGER) AS peak, round((high - m) / (1.4826 * s), 6) AS prominence FROM t JOIN m USING (vec_id) JOIN s USING (vec_id)""",
)
def peak_prominence(spark, d):
    return rounded(checks.prominence(windows_of(spark, d), "vec_id", "w", 3))


@query("canonical_order", "SELECT segment, freq_hz, row_number() OVER (PARTITION BY segment ORDER BY freq_hz) AS place FROM (SELECT DISTINCT segment, freq_hz FROM p)")
def canonical_order(spark, d):
    return points(spark, d).select("segment", "freq_hz").distinct().withColumn("place", F.row_number().over(Window.partitionBy("segment").orderBy("freq_hz")).cast("long"))


@query(
    "findings_ranking",
    """WITH v AS (SELECT s_nationkey AS plate, s_suppkey AS segment, s_acctbal FROM supplier), m AS (SELECT plate, median(s_acctbal) AS m FROM v GROUP BY plate), s AS (SELECT v.plate, median(abs(s_acctbal - m)) AS s FROM v JOIN m USING (plate) GROUP BY v.plate),
    z AS (SELECT v.plate, segment, round((s_acctbal - m) / (1.4826 * s), 9) AS z FROM v JOIN m USING (plate) JOIN s USING (plate) WHERE s > 0) SELECT plate, segment, round(z, 6) AS z, row_number() OVER (PARTITION BY plate ORDER BY abs(z) DESC, segment) AS rank FROM z WHERE abs(z) >= 0.5""",
)
def findings_ranking(spark, d):
    v = table(spark, d, "supplier").select(F.col("s_nationkey").alias("plate"), F.col("s_suppkey").alias("segment"), "s_acctbal")
    m = v.groupBy("plate").agg(F.median("s_acctbal").alias("m"))
    s = v.join(m, "plate").groupBy("plate", "m").agg(F.median(F.abs(F.col("s_acctbal") - F.col("m"))).alias("s")).where("s > 0")
    z = v.join(s, "plate").select("plate", "segment", F.round((F.col("s_acctbal") - F.col("m")) / (1.4826 * F.col("s")), 9).alias("z")).where(F.abs("z") >= 0.5)
    rank = F.row_number().over(Window.partitionBy("plate").orderBy(F.desc(F.abs("z")), "segment"))
    return z.select("plate", "segment", F.round("z", 6).alias("z"), rank.cast("long").alias("rank"))


@query(
    "anchor_card",
    """WITH t AS (SELECT card, freq_hz, avg(z_re) AS v FROM p GROUP BY ALL), r AS (SELECT a.card, b.card AS other, abs(corr(a.v, b.v)) AS r FROM t a JOIN t b ON a.freq_hz = b.freq_hz AND a.card <> b.card GROUP BY ALL),
    m AS (SELECT card, median(r) AS m FROM r GROUP BY card) SELECT card, round(m, 9) AS median_r, card = (SELECT arg_max(card, (m, card)) FROM m) AS is_anchor FROM m""",
)
def anchor_card(spark, d):
    t = points(spark, d).groupBy("card", "freq_hz").agg(F.avg("z_re").alias("v"))
    return rounded(checks.anchor(t, "card", "freq_hz", "v"), 9)


@query(
    "nyquist_zone",
    """WITH c AS (SELECT card, segment, atan2(avg(z_im), avg(z_re)) AS a, segment * 1e-5 AS tau FROM p GROUP BY card, segment),
    x AS (SELECT 0 AS zone, 120.0 AS hz, 1 AS side UNION ALL SELECT m, m * 1000.0 + s * 120.0, s FROM range(1, 5) r(m), (VALUES (-1), (1)) v(s)),
    q AS (SELECT card, zone, hz, sqrt(pow(sum(cos(side * a - 2 * pi() * hz * tau)), 2) + pow(sum(sin(side * a - 2 * pi() * hz * tau)), 2)) / count(*) AS r FROM c, x GROUP BY card, zone, side, hz),
    b AS (SELECT card, max(CASE WHEN zone = 0 THEN r END) AS base, arg_max({'zone': zone, 'hz': hz, 'r': r}, (round(r, 9), -hz)) AS b FROM q GROUP BY card)
    SELECT card, CAST(b.zone AS INTEGER) AS zone, CAST(b.hz AS DOUBLE) AS hz, round(b.r, 6) AS r, b.zone > 0 AND b.r > base + 0.15 AS undersampled FROM b""",
)
def nyquist_zone(spark, d):
    c = points(spark, d).groupBy("card", "segment").agg(F.atan2(F.avg("z_im"), F.avg("z_re")).alias("a")).withColumn("tau", F.col("segment") * 1e-5)
    return rounded(checks.nyquist_zones(c, "card", "a", "tau", 120.0, 1000.0))


@query("tile_geometry", f"WITH {PADS_SQL} SELECT DISTINCT c AS col, r AS \"row\", 44 - c AS turned_col, 19 - r AS turned_row, segment, CAST(c // 5 * 5 AS DOUBLE) * 2.5 AS x0_mm, CAST(r // 5 * 5 AS DOUBLE) * 2.5 AS y0_mm FROM pads")
def tile_geometry(spark, d):
    p = pads(spark, d).select("col", "row", "segment").distinct()
    corner = lambda c: F.floor(F.col(c) / 5) * 5 * 2.5
    return p.select("col", "row", (44 - F.col("col")).alias("turned_col"), (19 - F.col("row")).alias("turned_row"), "segment", corner("col").cast("double").alias("x0_mm"), corner("row").cast("double").alias("y0_mm"))


@query(
    "confined_windows",
    """WITH o AS (SELECT o_custkey AS card, o_orderkey AS step, epoch(o_orderdate) / 86400.0 AS a, epoch(o_orderdate) / 86400.0 + 40 + o_orderkey % 90 AS b FROM orders),
    n AS (SELECT card, step, a, least(b, coalesce(lead(a) OVER (PARTITION BY card ORDER BY a, b), b)) AS b FROM o) SELECT card, round(a, 6) AS start, round(b, 6) AS stop, count(*) AS n, b - a >= 20 AS kept FROM n GROUP BY card, a, b""",
)
def confined_windows(spark, d):
    day = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)") / 86400.0
    w = table(spark, d, "orders").select(F.col("o_custkey").alias("card"), day.alias("start"), (day + 40 + F.col("o_orderkey") % 90).alias("stop"))
    return rounded(checks.confined(w, ["card"], "start", "stop", 20.0).groupBy("card", "start", "stop", "kept").agg(F.count(F.lit(1)).alias("n")))


@query("chain_summary", "SELECT freq_hz, round(median(20 * log10(sqrt(z_re * z_re + z_im * z_im))), 6) AS gain_db, round(median(degrees(atan2(z_im, z_re))), 6) AS phase_deg, count(DISTINCT segment) AS n_segments FROM p GROUP BY freq_hz")
def chain_summary(spark, d):
    z = (F.col("z_re"), F.col("z_im"))
    p = points(spark, d).withColumn("gain_db", 20 * F.log10(impedance.magnitude(z))).withColumn("phase_deg", F.degrees(impedance.phase(z)))
    # few steps hold all rows, so their medians are taken by rank
    parts = p.select("freq_hz", F.explode(F.array(*[F.struct(F.lit(c).alias("part"), F.col(c).alias("v")) for c in ("gain_db", "phase_deg")])).alias("x")).select("freq_hz", "x.*")
    middle = robust.quantiles(parts, ["freq_hz", "part"], "v", [0.5])
    both = middle.groupBy("freq_hz").agg(*[F.max(F.when(F.col("part") == c, F.col("quantile"))).alias(c) for c in ("gain_db", "phase_deg")])
    return rounded(both.join(p.groupBy("freq_hz").agg(F.countDistinct("segment").alias("n_segments")), "freq_hz").select("freq_hz", "gain_db", "phase_deg", "n_segments"))


@query(
    "coverage_summary",
    "WITH c AS (SELECT card, freq_hz, count(DISTINCT segment) AS n FROM p WHERE snr_db >= 10 GROUP BY ALL), t AS (SELECT card, max(n) AS m FROM c GROUP BY card), r AS (SELECT card, n / m AS share FROM c JOIN t USING (card)) "
    "SELECT card, count(*) AS n_steps, count(*) FILTER (WHERE share >= 0.8) AS n_covered, round(min(CASE WHEN share >= 0.8 THEN share END), 6) AS least, round(max(CASE WHEN share >= 0.8 THEN share END), 6) AS largest, round(median(CASE WHEN share >= 0.8 THEN share END), 6) AS middle FROM r GROUP BY card",
)
def coverage_summary(spark, d):
    c = points(spark, d).where("snr_db >= 10").groupBy("card", "freq_hz").agg(F.countDistinct("segment").alias("n"))
    r = c.join(c.groupBy("card").agg(F.max("n").alias("m")), "card").withColumn("share", F.col("n") / F.col("m"))
    covered = F.when(F.col("share") >= 0.8, F.col("share"))
    return rounded(r.groupBy("card").agg(F.count(F.lit(1)).alias("n_steps"), F.count(covered).alias("n_covered"), F.min(covered).alias("least"), F.max(covered).alias("largest"), F.median(covered).alias("middle")))


@query(
    "channel_inventory",
    "WITH n AS (SELECT p_partkey % 5 AS card, CASE p_size % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN 'UC' || p_size WHEN 2 THEN 'Temp_' || p_size ELSE p_brand END AS name FROM part), "
    "r AS (SELECT DISTINCT card, name, CASE WHEN regexp_matches(name, '^-?\\d+$') THEN 'segment' WHEN upper(name) LIKE 'UC%' THEN 'cell_voltage' WHEN lower(name) LIKE 'temp%' THEN 'temperature' ELSE 'other' END AS role FROM n) "
    "SELECT card, role, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names FROM r GROUP BY ALL",
)
def channel_inventory(spark, d):
    s, kind = F.col("p_size").cast("string"), F.col("p_size") % 4
    name = F.when(kind == 0, s).when(kind == 1, F.concat(F.lit("UC"), s)).when(kind == 2, F.concat(F.lit("Temp_"), s)).otherwise(F.col("p_brand"))
    n = table(spark, d, "part").select((F.col("p_partkey") % 5).alias("card"), name.alias("name")).distinct()
    return n.groupBy("card", text.channel_role(F.col("name")).alias("role")).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("name")), ",").alias("names"))


@query("channel_levels", "SELECT card, segment, count(*) AS n, round(avg(value), 6) AS dc, round(stddev_pop(value), 6) AS ac, min(t_us) AS first_us, max(t_us) AS last_us FROM e GROUP BY ALL")
def channel_levels(spark, d):
    return rounded(events(spark, d).groupBy("card", "segment").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("dc"), F.stddev_pop("value").alias("ac"), F.min("t_us").alias("first_us"), F.max("t_us").alias("last_us")))


@query(
    "spectrum_outliers",
    f"""WITH {SPECTRA_SQL}, {PADS_SQL}, {ADJACENT_SQL}, r AS (SELECT a.segment, freq_hz, median(re) AS r, median(im) AS i FROM adj a JOIN s ON a.neighbour = s.segment GROUP BY ALL),
    q AS (SELECT s.segment, freq_hz, 20 * log10(sqrt(re * re + im * im) / sqrt(r * r + i * i)) AS db, atan2(im, re) - atan2(i, r) AS turn FROM s JOIN r USING (segment, freq_hz))
    SELECT segment, count(*) AS n_points, round(median(db), 6) AS median_db, round(arg_max(db, (abs(round(db, 9)), freq_hz)), 6) AS worst_db, round(median(degrees(atan2(sin(turn), cos(turn)))), 6) AS median_deg FROM q GROUP BY segment HAVING count(*) >= 4""",
)
def spectrum_outliers(spark, d):
    return rounded(checks.spectrum_outliers(plate_spectra(spark, d), joins.adjacency(pads(spark, d))))


@query("half_coverage_grid", "WITH t AS (SELECT count(DISTINCT segment) AS n FROM p), g AS (SELECT freq_hz, count(DISTINCT segment) AS n_segments FROM p GROUP BY freq_hz) SELECT freq_hz, n_segments, round(n_segments / n, 6) AS share FROM g, t WHERE n_segments / n >= 0.5")
def half_coverage_grid(spark, d):
    return rounded(checks.half_coverage_grid(points(spark, d), "segment", "freq_hz"))


@query("plate_reference", "SELECT round(freq_hz, 6) AS freq_hz, round(median(z_re), 6) AS re, round(median(z_im), 6) AS im, count(*) AS n FROM p WHERE snr_db >= 4 AND thd <= 0.07 GROUP BY 1")
def plate_reference(spark, d):
    return rounded(points(spark, d).where("snr_db >= 4 AND thd <= 0.07").groupBy(F.round("freq_hz", 6).alias("freq_hz")).agg(F.median("z_re").alias("re"), F.median("z_im").alias("im"), F.count(F.lit(1)).alias("n")))


@query(
    "start_times",
    "WITH s AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE strftime(ts, '%d.%m.%Y %H:%M:%S') END AS t FROM events) SELECT event_id, CAST(epoch(try_strptime(t, '%d.%m.%Y %H:%M:%S')) AS BIGINT) AS start_s FROM s",
)
def start_times(spark, d):
    written = F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(F.date_format("ts", "dd.MM.yyyy HH:mm:ss"))
    return table(spark, d, "events").select("event_id", F.unix_timestamp(F.try_to_timestamp(written, F.lit("dd.MM.yyyy HH:mm:ss"))).alias("start_s"))


@query(
    "nominal_labels",
    "SELECT l_orderkey, l_linenumber, CASE WHEN abs(x - 45) <= 0.9 THEN '45A' WHEN abs(x - 60) <= 1.2 THEN '60A' WHEN abs(x - 150) <= 3 THEN '150A' WHEN abs(x - 225) <= 4.5 THEN '225A' WHEN abs(x - 300) <= 6 THEN '300A' WHEN abs(x - 450) <= 9 THEN '450A' ELSE CAST(round(x) AS BIGINT) || 'A' END AS label FROM (SELECT *, l_quantity * 9.3 AS x FROM lineitem)",
)
def nominal_labels(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.nominal_label(F.col("l_quantity") * 9.3).alias("label"))


@query(
    "shunt_and_temperature",
    "SELECT c_custkey, round(c_acctbal / 1000 / (0.5 + 1e-3 * c_nationkey * 20 * pi() + 0.001 * pi()), 9) AS density, round((c_acctbal / 1000 - 0.1) / CASE WHEN c_nationkey <> 0 THEN c_nationkey / (16 * pi()) END, 9) AS celsius FROM customer",
)
def shunt_and_temperature(spark, d):
    volts, c1 = F.col("c_acctbal") / 1000, F.col("c_nationkey").cast("double")
    return rounded(table(spark, d, "customer").select("c_custkey", impedance.current_density(volts, F.lit(0.5) + 0.001 * F.pi(), c1, 20 * F.pi()).alias("density"), impedance.celsius(volts, F.lit(0.1), c1 / (16 * F.pi())).alias("celsius")), 9)


@query(
    "gas_supply",
    "SELECT p_partkey, round(611.2 * exp(17.62 * p_size / (243.12 + p_size)), 4) AS saturation_pa, round(611.2 * exp(17.62 * p_size / (243.12 + p_size)) / 250000, 9) AS fraction, round(p_retailprice / 100 * 0.2095 / 22.414 / 60 / (p_size * 9 / (4 * 96485.33212)), 6) AS lambda_air FROM part",
)
def gas_supply(spark, d):
    t = F.col("p_size")
    return table(spark, d, "part").select("p_partkey", F.round(impedance.saturation_pascal(t), 4).alias("saturation_pa"), F.round(impedance.mole_fraction(t, F.lit(250000)), 9).alias("fraction"), F.round(impedance.stoichiometry(t * 9, F.col("p_retailprice") / 100), 6).alias("lambda_air"))


@query(
    "deskewed_spectra",
    """WITH t AS (SELECT *, 2 * pi() * freq_hz * (card * 1e-4) AS a FROM p) SELECT point_id, line, round(z_re * cos(a) - z_im * sin(a), 6) AS re, round(z_re * sin(a) + z_im * cos(a), 6) AS im, round(z_re - z_im * 2 * pi() * freq_hz * 1e-3, 6) AS passed_re, round(z_im + z_re * 2 * pi() * freq_hz * 1e-3, 6) AS passed_im FROM t""",
)
def deskewed_spectra(spark, d):
    z = (F.col("z_re"), F.col("z_im"))
    late, passed = impedance.delayed(z, F.col("freq_hz"), F.col("card") * 1e-4), impedance.low_pass_corrected(z, F.col("freq_hz"), F.lit(1e-3))
    return rounded(points(spark, d).select("point_id", "line", late[0].alias("re"), late[1].alias("im"), passed[0].alias("passed_re"), passed[1].alias("passed_im")))


@query(
    "relative_uncertainty",
    "SELECT point_id, line, round(sqrt((1 - c) / (2 * CASE WHEN c * area > 0 THEN c * area END)), 9) AS sigma, round(-10 * log10(pow(10.0, -snr_db / 10) + pow(10.0, -area / 10)), 6) AS snr_db FROM (SELECT *, thd * 12 AS c FROM p)",
)
def relative_uncertainty(spark, d):
    p = points(spark, d)
    return p.select("point_id", "line", F.round(signal.relative_sigma(F.col("thd") * 12, F.col("area")), 9).alias("sigma"), F.round(signal.combined_snr(F.col("snr_db"), F.col("area")), 6).alias("snr_db"))


def timed(spark, d):
    return table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("t"), F.col("event_type").alias("card"), F.col("user_id").alias("segment"), "value")


@query("tumbling_frames", "SELECT event_type AS card, user_id AS segment, CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) AS start_s, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS rms FROM events GROUP BY ALL")
def tumbling_frames(spark, d):
    f = samples.frames(timed(spark, d), "1 hour")
    return f.select("card", "segment", F.unix_timestamp("start").alias("start_s"), "n", F.round("mean", 6).alias("mean"), F.round("rms", 6).alias("rms"))


@query(
    "sliding_frames",
    "WITH s AS (SELECT *, epoch(time_bucket(INTERVAL 1 HOUR, ts)) - 3600 * k AS start_s FROM events, range(2) r(k)) SELECT event_type AS card, user_id AS segment, CAST(start_s AS BIGINT) AS start_s, count(*) AS n, round(avg(value), 6) AS mean FROM s GROUP BY ALL",
)
def sliding_frames(spark, d):
    f = samples.frames(timed(spark, d), "2 hours", "1 hour")
    return f.select("card", "segment", F.unix_timestamp("start").alias("start_s"), "n", F.round("mean", 6).alias("mean"))


@query(
    "min_max_thinned",
    "WITH b AS (SELECT event_type AS card, CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) AS start_s, ts, value FROM events) SELECT card, start_s, arg_min(value, (value, ts)) AS low, arg_max(value, (value, ts)) AS high, epoch_us(arg_min(ts, (value, ts))) AS low_us, epoch_us(arg_max(ts, (value, ts))) AS high_us FROM b GROUP BY ALL",
)
def min_max_thinned(spark, d):
    f = samples.thinned(timed(spark, d), "1 hour")
    return f.select("card", F.unix_timestamp("start").alias("start_s"), F.col("low_value").alias("low"), F.col("high_value").alias("high"), F.unix_micros("low_t").alias("low_us"), F.unix_micros("high_t").alias("high_us"))


@query(
    "dwell_sessions",
    """WITH g AS (SELECT event_type AS card, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) < INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS fresh FROM events), s AS (SELECT *, sum(fresh) OVER (PARTITION BY card ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT card, epoch_us(min(ts)) AS start_us, count(*) AS n, round(avg(value), 6) AS mean FROM s GROUP BY card, k""",
)
def dwell_sessions(spark, d):
    f = samples.dwells(timed(spark, d), "10 minutes")
    return f.select("card", F.unix_micros("start").alias("start_us"), "n", F.round("mean", 6).alias("mean"))


@query(
    "upserted_runs",
    "SELECT o_orderkey AS run, o_totalprice AS value, NULL AS remark FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') UNION ALL SELECT l_orderkey, max(l_extendedprice), l_returnflag FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL",
)
def upserted_runs(spark, d):
    from . import publish

    old = table(spark, d, "orders").select(F.col("o_orderkey").alias("run"), F.col("o_totalprice").alias("value"))
    new = table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("run"), F.col("l_returnflag").alias("remark")).agg(F.max("l_extendedprice").alias("value"))
    schema = publish.common_schema(old.schema, new.schema)
    return publish.aligned(old.join(new, "run", "left_anti"), schema).unionByName(publish.aligned(new, schema))


@query(
    "tidy_columns",
    "SELECT 'r1' AS run_key, p_partkey AS z_re_ohm_cm2, p_size AS z_re_ohm_cm2_2, p_retailprice AS c_1_khz FROM part",
)
def tidy_columns(spark, d):
    from . import publish

    odd = table(spark, d, "part").select(F.col("p_partkey").alias("Z re [Ohm cm2]"), F.col("p_size").alias("z_re_ohm_cm2"), F.col("p_retailprice").alias("1 kHz"))
    return publish.tidy(odd, {"run_key": "r1"})
