"""Gates, aggregates and joins over spectra (lineitem as measured points)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import aggregate, gates, joins, robust, signal, windows
from .registry import points, query, rounded, table

CELL_AREA = 300.0
GATES_SQL = """CASE WHEN NOT coalesce(freq_hz BETWEEN 6 AND 78, false) THEN 'outside_band' WHEN NOT coalesce(snr_db >= 4, false) THEN 'snr'
  WHEN NOT coalesce(thd <= 0.07, false) THEN 'thd' WHEN NOT coalesce(sqrt(z_re * z_re + z_im * z_im) BETWEEN 5 AND 95, false) THEN 'magnitude' ELSE '' END"""


def point_gates() -> list[gates.Gate]:
    size = F.sqrt(F.col("z_re") * F.col("z_re") + F.col("z_im") * F.col("z_im"))
    return [("outside_band", gates.band("freq_hz", 6, 78)), ("snr", F.col("snr_db") >= 4), ("thd", F.col("thd") <= 0.07), ("magnitude", size.between(5, 95))]


@query("gate_ledger_first_reason", f"SELECT reason, segment, count(*) AS n, round(sum(freq_hz), 6) AS f_sum FROM (SELECT *, {GATES_SQL} AS reason FROM p) GROUP BY ALL")
def gate_ledger_first_reason(spark, d):
    return gates.ledger(points(spark, d), point_gates()).groupBy("reason", "segment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("freq_hz"), 6).alias("f_sum"))


@query(
    "segment_reach",
    f"""WITH g AS (SELECT *, {GATES_SQL} AS reason FROM p), m AS (SELECT *, max(CASE WHEN reason = '' THEN freq_hz END) OVER (PARTITION BY segment) AS top FROM g),
    a AS (SELECT *, (reason <> '' AND (top IS NULL OR freq_hz > top)) AS above FROM m), r AS (SELECT segment, reason, count(*) AS n FROM a WHERE above GROUP BY ALL),
    b AS (SELECT segment, arg_min(reason, (-n, reason)) AS blocked_by FROM r GROUP BY segment),
    s AS (SELECT segment, count(*) AS n_points, count(*) FILTER (WHERE reason = '') AS n_kept, min(CASE WHEN reason = '' THEN freq_hz END) AS f_min_kept, max(top) AS f_max_kept, count(*) FILTER (WHERE above) AS n_above FROM a GROUP BY segment)
    SELECT s_suppkey AS segment, coalesce(n_points, 0) AS n_points, coalesce(n_kept, 0) AS n_kept, f_min_kept, f_max_kept, coalesce(n_above, 0) AS n_above, CASE WHEN n_points IS NULL THEN 'no_channel' ELSE coalesce(blocked_by, '') END AS blocked_by
    FROM supplier LEFT JOIN s ON s_suppkey = s.segment LEFT JOIN b ON s_suppkey = b.segment""",
)
def segment_reach(spark, d):
    plate = table(spark, d, "supplier").select(F.col("s_suppkey").alias("segment"))
    return gates.reach(gates.ledger(points(spark, d), point_gates()), "segment", "freq_hz", plate)


@query("reason_tally_topk", f"SELECT card, reason, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY card ORDER BY n DESC, reason) AS rank FROM (SELECT card, {GATES_SQL} AS reason, count(*) AS n FROM p GROUP BY ALL) WHERE reason <> '') WHERE rank <= 3")
def reason_tally_topk(spark, d):
    return gates.tally(gates.ledger(points(spark, d), point_gates()), "card", 3)


@query(
    "tier_grade",
    """SELECT tier, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM (SELECT o_totalprice, CASE WHEN o_totalprice <= 1000 THEN 'C' WHEN o_orderstatus = 'F' THEN 'C'
    WHEN res <= 0.01 AND cv <= 0.10 THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'B' ELSE 'A' END WHEN res <= 0.03 AND cv <= 0.25 THEN 'B' ELSE 'C' END AS tier
    FROM (SELECT *, (o_orderkey % 50) / 1000.0 AS res, (o_custkey % 40) / 100.0 AS cv FROM orders)) GROUP BY tier""",
)
def tier_grade(spark, d):
    o = table(spark, d, "orders")
    grade = gates.tier(F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice")), (F.col("o_orderkey") % 50) / 1000.0, (F.col("o_custkey") % 40) / 100.0, 0.01, F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus") == "F")
    return o.withColumn("tier", grade).groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("median_by_step", "SELECT freq_hz, median(z_re) AS re_median, median(z_im) AS im_median, count(DISTINCT segment) AS n_segments FROM p GROUP BY freq_hz HAVING count(DISTINCT segment) >= 50")
def median_by_step(spark, d):
    p = points(spark, d)
    many = p.groupBy("freq_hz").agg(F.countDistinct("segment").alias("n_segments")).where("n_segments >= 50")
    # few steps hold all rows, so their medians are taken by rank
    parts = p.select("freq_hz", F.explode(F.array(*[F.struct(F.lit(c).alias("part"), F.col(c).alias("v")) for c in ("z_re", "z_im")])).alias("x")).select("freq_hz", "x.*")
    middle = robust.quantiles(parts, ["freq_hz", "part"], "v", [0.5])
    both = middle.groupBy("freq_hz").agg(*[F.max(F.when(F.col("part") == c, F.col("quantile"))).alias(name) for c, name in (("z_re", "re_median"), ("z_im", "im_median"))])
    return both.join(many, "freq_hz").select("freq_hz", "re_median", "im_median", "n_segments")


@query(
    "step_coverage",
    f"""WITH v AS (SELECT freq_hz, segment, bool_or({GATES_SQL} = '') AS ok FROM p GROUP BY ALL), t AS (SELECT count(*) AS n, sum(s_suppkey % 7 + 1) AS a FROM supplier)
    SELECT freq_hz, count(*) FILTER (WHERE ok) AS n_valid, round(sum(CASE WHEN ok THEN segment % 7 + 1 ELSE 0 END) / max(t.a), 6) AS area_share FROM v, t GROUP BY freq_hz""",
)
def step_coverage(spark, d):
    plate = table(spark, d, "supplier").select((F.col("s_suppkey") % 7 + 1).cast("double").alias("a")).agg(F.sum("a").alias("whole"))
    valid = gates.ledger(points(spark, d), point_gates()).groupBy("freq_hz", "segment").agg(F.bool_or("kept").alias("ok"))
    shares = valid.groupBy("freq_hz").agg(F.count_if("ok").alias("n_valid"), F.sum(F.when(F.col("ok"), F.col("segment") % 7 + 1).otherwise(0)).alias("a"))
    return shares.join(F.broadcast(plate)).select("freq_hz", "n_valid", F.round(F.col("a") / F.col("whole"), 6).alias("area_share"))


@query(
    "parallel_aggregate",
    """WITH y AS (SELECT freq_hz, area, area * z_re / (z_re * z_re + z_im * z_im) AS yr, -area * z_im / (z_re * z_re + z_im * z_im) AS yi FROM p WHERE z_re * z_re + z_im * z_im > 0),
    s AS (SELECT freq_hz, sum(yr) AS yr, sum(yi) AS yi, sum(area) AS area_used, count(*) AS n_segments FROM y GROUP BY freq_hz)
    SELECT freq_hz, round(yr / (yr * yr + yi * yi), 9) AS z_re, round(-yi / (yr * yr + yi * yi), 9) AS z_im, round(yr / (yr * yr + yi * yi) * area_used, 6) AS z_used_re, round(-yi / (yr * yr + yi * yi) * area_used, 6) AS z_used_im,
    round(yr / (yr * yr + yi * yi) * 300, 6) AS z_full_re, round(-yi / (yr * yr + yi * yi) * 300, 6) AS z_full_im, area_used, round(area_used / 300, 6) AS coverage, n_segments FROM s""",
)
def parallel_aggregate(spark, d):
    out = aggregate.parallel_sum(points(spark, d), ["freq_hz"], "area", "z_re", "z_im", CELL_AREA)
    return out.select(*[F.round(c, 9 if c in ("z_re", "z_im") else 6).alias(c) if c not in ("freq_hz", "area_used", "n_segments") else F.col(c) for c in out.columns])


@query("frequency_intersection", "SELECT round(freq_hz, 6) AS key, count(DISTINCT segment) AS n_members FROM p GROUP BY 1 HAVING count(DISTINCT segment) = (SELECT count(DISTINCT segment) FROM p)")
def frequency_intersection(spark, d):
    return aggregate.in_every(points(spark, d), "segment", F.round("freq_hz", 6))


@query("dc_closure", "SELECT freq_hz, round(sum(snr_db * area) * 300 / sum(area), 6) AS total, round(100 * (sum(snr_db * area) * 300 / sum(area) / 6000 - 1), 6) AS deviation_pct FROM p GROUP BY freq_hz")
def dc_closure(spark, d):
    return rounded(points(spark, d).groupBy("freq_hz").agg(*aggregate.dc_closure(F.col("snr_db"), F.col("area"), CELL_AREA, F.lit(6000.0))))


@query(
    "tile_stats",
    """WITH v AS (SELECT s_nationkey AS nation, segment, avg(z_re) AS r FROM p JOIN supplier ON s_suppkey = segment GROUP BY ALL)
    SELECT nation, count(r) AS n_tiles, round(avg(r), 6) AS mean, round(median(r), 6) AS median, round(stddev_samp(r), 6) AS sd, round(100 * stddev_samp(r) / avg(r), 6) AS cv_pct, round(min(r), 6) AS min, round(max(r), 6) AS max, round(100 * (max(r) - min(r)) / avg(r), 6) AS span_pct FROM v GROUP BY nation""",
)
def tile_stats(spark, d):
    of = table(spark, d, "supplier").select(F.col("s_suppkey").alias("segment"), F.col("s_nationkey").alias("nation"))
    tiles = points(spark, d).groupBy("segment").agg(F.avg("z_re").alias("r")).join(of, "segment")
    return rounded(tiles.groupBy("nation").agg(*aggregate.tile_stats("r")))


FAULTS = {"dry": {"a_ratio": (1.02, None), "b_ratio": (None, 1.01)}, "flooded": {"b_ratio": (1.01, None), "c_ratio": (1.01, None)}, "contact": {"a_ratio": (1.01, None), "c_ratio": (None, 0.99)}}


@query(
    "fault_labels",
    """WITH v AS (SELECT segment, avg(z_re) AS a, avg(area) AS b, avg(snr_db) AS c FROM p GROUP BY segment), m AS (SELECT median(a) AS ma, median(b) AS mb, median(c) AS mc FROM v),
    r AS (SELECT segment, a / ma AS ar, b / mb AS br, c / mc AS cr FROM v, m)
    SELECT segment, round(ar, 6) AS a_ratio, concat_ws('|', CASE WHEN ar >= 1.02 AND br <= 1.01 THEN 'dry' END, CASE WHEN br >= 1.01 AND cr >= 1.01 THEN 'flooded' END, CASE WHEN ar >= 1.01 AND cr <= 0.99 THEN 'contact' END) AS fault FROM r""",
)
def fault_labels(spark, d):
    values = points(spark, d).groupBy("segment").agg(F.avg("z_re").alias("a"), F.avg("area").alias("b"), F.avg("snr_db").alias("c"))
    return aggregate.ratio_to_median(values, ["a", "b", "c"]).select("segment", F.round("a_ratio", 6).alias("a_ratio"), aggregate.fault_labels(FAULTS).alias("fault"))


@query("linear_closure_fit", "SELECT o_orderpriority AS condition, round(regr_slope(o_totalprice, o_custkey), 6) AS slope, round(regr_intercept(o_totalprice, o_custkey), 4) AS intercept, round(regr_r2(o_totalprice, o_custkey), 9) AS r2, count(*) AS n FROM orders GROUP BY 1")
def linear_closure_fit(spark, d):
    out = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("condition")).agg(*aggregate.line("o_custkey", "o_totalprice"))
    return out.select("condition", F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), F.round("r2", 9).alias("r2"), "n")


@query("origin_slope", "SELECT segment, round(sum(area * z_re) / sum(area * area), 9) AS slope FROM p GROUP BY segment")
def origin_slope(spark, d):
    return points(spark, d).groupBy("segment").agg(F.round(aggregate.origin_slope(F.col("area"), F.col("z_re")), 9).alias("slope"))


@query(
    "two_level_regression",
    """WITH a AS (SELECT segment, freq_hz, regr_slope(z_re, area) AS r, regr_r2(z_re, area) AS r2, avg(snr_db) AS t FROM p GROUP BY ALL HAVING regr_slope(z_re, area) IS NOT NULL AND var_pop(area) > 0)
    SELECT segment, round(regr_intercept(r, t) / 4.235, 6) AS c0, round(regr_slope(r, t) / 4.235, 6) AS c1, round(min(r2), 6) AS r2_min, count(*) AS n_steps FROM a GROUP BY segment""",
)
def two_level_regression(spark, d):
    return rounded(aggregate.two_level(points(spark, d), "segment", "freq_hz", "snr_db", "area", "z_re", 4.235))


@query(
    "weighted_linfit",
    """WITH s AS (SELECT segment, sum(w) AS sw, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM (SELECT segment, freq_hz AS x, z_re AS y, area AS w FROM p) GROUP BY segment)
    SELECT segment, round((sw * sxy - sx * sy) / (sw * sxx - sx * sx), 6) AS slope, round((sxx * sy - sx * sxy) / (sw * sxx - sx * sx), 6) AS intercept FROM s""",
)
def weighted_linfit(spark, d):
    return rounded(points(spark, d).groupBy("segment").agg(*aggregate.weighted_line(F.col("freq_hz"), F.col("z_re"), F.col("area"))))


@query("sigma_from_snr", "SELECT segment, round(avg(least(1.0, greatest(0.001, sqrt(1 / (area * pow(10.0, snr_db / 10)))))), 9) AS sigma, round(avg(-10 * log10(pow(10.0, -snr_db / 10) + pow(10.0, -area / 10))), 6) AS snr_comb_db FROM p GROUP BY segment")
def sigma_from_snr(spark, d):
    return points(spark, d).groupBy("segment").agg(F.round(F.avg(signal.sigma_from_snr(F.col("snr_db"), F.col("area"))), 9).alias("sigma"), F.round(F.avg(signal.combined_snr(F.col("snr_db"), F.col("area"))), 6).alias("snr_comb_db"))


@query(
    "interp_log",
    """WITH s AS (SELECT card, freq_hz, avg(z_re) AS z FROM p WHERE freq_hz > 0 GROUP BY ALL), g AS (SELECT c.card, f.f AS freq_hz FROM (SELECT DISTINCT card FROM p) c, (SELECT unnest([1.5, 6.0, 10.5, 40.0, 70.25, 100.0]::DOUBLE[]) AS f) f),
    b AS (SELECT g.*, s.freq_hz AS f0, s.z AS z0 FROM g ASOF LEFT JOIN s ON g.card = s.card AND g.freq_hz >= s.freq_hz), a AS (SELECT b.*, s.freq_hz AS f1, s.z AS z1 FROM b ASOF LEFT JOIN s ON b.card = s.card AND b.freq_hz <= s.freq_hz)
    SELECT card, freq_hz, round(CASE WHEN f0 IS NULL THEN z1 WHEN f1 IS NULL THEN z0 WHEN f1 > f0 THEN z0 + (z1 - z0) * (ln(freq_hz) - ln(f0)) / (ln(f1) - ln(f0)) ELSE z0 END, 6) AS z FROM a""",
)
def interp_log(spark, d):
    p = points(spark, d)
    known = p.where("freq_hz > 0").groupBy("card", "freq_hz").agg(F.avg("z_re").alias("z"))
    grid = p.select("card").distinct().select("card", F.explode(F.array(*map(F.lit, (1.5, 6.0, 10.5, 40.0, 70.25, 100.0)))).alias("freq_hz"))
    return rounded(joins.interpolate_log(known, grid, ["card"], "freq_hz", ["z"]))


@query("duplicate_segment_keep_best", "WITH m AS (SELECT segment, flag, median(snr_db) AS s FROM p GROUP BY ALL), b AS (SELECT segment, arg_min(flag, (-s, flag)) AS flag FROM m GROUP BY segment) SELECT segment, flag, count(*) AS n, round(sum(z_re), 2) AS z_sum FROM p SEMI JOIN b USING (segment, flag) GROUP BY ALL")
def duplicate_segment_keep_best(spark, d):
    return joins.keep_best(points(spark, d), "segment", "flag", "snr_db").groupBy("segment", "flag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("z_re"), 2).alias("z_sum"))


@query(
    "worst_verdict",
    """SELECT segment, CASE max(CASE WHEN r IS NULL THEN 0 WHEN r <= 45 THEN 1 WHEN r <= 55 THEN 2 ELSE 3 END) WHEN 3 THEN 'fail' WHEN 2 THEN 'warn' WHEN 1 THEN 'pass' ELSE 'na' END AS verdict, count(*) AS n_checks
    FROM (SELECT segment, freq_hz, avg(z_re) AS r FROM p GROUP BY ALL) GROUP BY segment""",
)
def worst_verdict(spark, d):
    checks = points(spark, d).groupBy("segment", "freq_hz").agg(F.avg("z_re").alias("r")).withColumn("verdict", gates.verdict(F.col("r"), 45, 55))
    return checks.groupBy("segment").agg(gates.worst_verdict("verdict").alias("verdict"), F.count(F.lit(1)).alias("n_checks"))


@query(
    "cumulative_upstream_share",
    "WITH s AS (SELECT card, segment, sum(area) AS a FROM p GROUP BY ALL) SELECT card, segment, round(coalesce(sum(a) OVER (PARTITION BY card ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(a) OVER (PARTITION BY card), 9) AS upstream FROM s",
)
def cumulative_upstream_share(spark, d):
    s = points(spark, d).groupBy("card", "segment").agg(F.sum("area").alias("a"))
    return rounded(windows.cumulative_share(s, ["card"], ["segment"], "a").select("card", "segment", "upstream"), 9)


@query(
    "topband_weighted_mean",
    """WITH s AS (SELECT segment, freq_hz, avg(z_re) AS re, avg(snr_db) AS snr FROM p GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY freq_hz DESC) AS rank, max(freq_hz) OVER (PARTITION BY segment) AS top FROM s),
    t AS (SELECT *, 1 / pow(greatest(re * sqrt(1 / pow(10.0, snr / 10)), 1e-15), 2) AS w FROM k WHERE rank <= 8 AND (rank <= 3 OR freq_hz >= top * pow(10.0, -0.35)))
    SELECT segment, round(sum(w * re) / sum(w), 6) AS r, round(sqrt(1 / sum(w)), 9) AS sd, count(*) AS n FROM t GROUP BY segment""",
)
def topband_weighted_mean(spark, d):
    s = points(spark, d).groupBy("segment", "freq_hz").agg(F.avg("z_re").alias("re"), F.avg("snr_db").alias("snr"))
    by = Window.partitionBy("segment")
    s = s.withColumn("rank", F.row_number().over(by.orderBy(F.desc("freq_hz")))).withColumn("top", F.max("freq_hz").over(by))
    s = s.where((F.col("rank") <= 8) & ((F.col("rank") <= 3) | (F.col("freq_hz") >= F.col("top") * F.pow(F.lit(10.0), F.lit(-0.35)))))
    w = 1 / F.pow(F.greatest(F.col("re") * F.sqrt(1 / F.pow(F.lit(10.0), F.col("snr") / 10)), F.lit(1e-15)), 2)
    return s.withColumn("w", w).groupBy("segment").agg(F.round(F.sum(F.col("w") * F.col("re")) / F.sum("w"), 6).alias("r"), F.round(F.sqrt(1 / F.sum("w")), 9).alias("sd"), F.count(F.lit(1)).alias("n"))


@query("trend_by_condition", "SELECT flag, status, CAST(year(make_date(1995, 1, 1)) + floor((freq_hz - 1) / 12) AS BIGINT) AS condition, round(median(z_re), 6) AS r_median, count(*) AS n FROM p GROUP BY ALL")
def trend_by_condition(spark, d):
    year = (1995 + F.floor((F.col("freq_hz") - 1) / 12)).cast("long")
    return points(spark, d).groupBy("flag", "status", year.alias("condition")).agg(F.round(F.median("z_re"), 6).alias("r_median"), F.count(F.lit(1)).alias("n"))


@query(
    "series_resistance_parallel",
    """WITH v AS (SELECT segment, card, avg(z_re) AS r, avg(area) AS a, stddev_samp(z_re) AS sd FROM p GROUP BY ALL)
    SELECT card, round(300 / sum(a / r), 6) AS r_parallel, round(sqrt(sum(pow(300 * a * sd / (r * r), 2))) / pow(sum(a / r), 2), 6) AS r_sd FROM v WHERE r > 0 GROUP BY card""",
)
def series_resistance_parallel(spark, d):
    v = points(spark, d).groupBy("segment", "card").agg(F.avg("z_re").alias("r"), F.avg("area").alias("a"), F.stddev_samp("z_re").alias("sd"))
    r, sd = aggregate.parallel_resistance(F.col("a"), F.col("r"), F.col("sd"), CELL_AREA)
    return rounded(v.groupBy("card").agg(r.alias("r_parallel"), sd.alias("r_sd")))


@query(
    "pooled_reference_phasor",
    """SELECT freq_hz, round(sum(area * z_re) / sum(area), 6) AS re, round(sum(area * z_im) / sum(area), 6) AS im, round(10 * log10(sum(pow(10.0, snr_db / 10))), 6) AS snr_db, round(atan2(sum(sin(z_im)), sum(cos(z_im))), 6) AS phase
    FROM p WHERE flag = 'A' GROUP BY freq_hz HAVING count(*) >= 2""",
)
def pooled_reference_phasor(spark, d):
    p = points(spark, d).where("flag = 'A'")
    out = p.groupBy("freq_hz").agg(*aggregate.pooled_phasor(F.col("z_re"), F.col("z_im"), F.col("snr_db"), F.col("area")), aggregate.circular_mean(F.col("z_im")).alias("phase"))
    return rounded(out.where("re IS NOT NULL"))


@query(
    "sweep_grid_check",
    """WITH f AS (SELECT DISTINCT card, pow(10.0, floor(freq_hz / 7) / 10) AS f FROM p), k AS (SELECT card, log10(f) AS y, CAST(row_number() OVER (PARTITION BY card ORDER BY f) AS DOUBLE) AS x FROM f),
    l AS (SELECT card, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, count(*) AS n FROM k GROUP BY card)
    SELECT card, n, round(max(abs(pow(10.0, y - b * x - a) - 1)) * 1e6, 3) AS residual_ppm, round(1 / max(b), 6) AS per_decade, (n >= 3 AND max(abs(pow(10.0, y - b * x - a) - 1)) * 1e6 < 5000 AND abs(1 / max(b) - round(1 / max(b))) < 0.15) AS regular FROM k JOIN l USING (card) GROUP BY card, n""",
)
def sweep_grid_check(spark, d):
    f = points(spark, d).select("card", F.pow(F.lit(10.0), F.floor(F.col("freq_hz") / 7) / 10).alias("f")).distinct()
    out = windows.grid_check(f, ["card"], "f")
    return out.select("card", "n", F.round("residual_ppm", 3).alias("residual_ppm"), F.round("per_decade", 6).alias("per_decade"), "regular")


