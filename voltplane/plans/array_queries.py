"""Detection over channels, ladders, and lags of cards over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import detection, lags
from .registry import events, points, query, rounded, table
from .table_queries import DOUBLES_SQL, sums_sql, windows_of

CK, SK = sums_sql("k")
C5, S5 = sums_sql(5)
#: Background bins on a side, bins between them and the tone, and the false-alarm rate of the count test.
N_BG, GUARD, ALPHA = 8, 1, 1e-3


def recording(spark, d):
    """Vectors as a recording of eight channels: channel = id modulo 8, chunks of 64 samples in order of ids."""
    e = table(spark, d, "embeddings")
    return e.select(F.lit("e").alias("path"), (F.col("vec_id") % 8).cast("string").alias("channel"), (F.floor(F.col("vec_id") / 8) * 64).alias("first_sample"), F.lit(64.0).alias("fs"), F.col("embedding").alias("samples"))


@query(
    "array_detections",
    f"""WITH {DOUBLES_SQL}, c AS (SELECT vec_id // 8 * 64 AS first_sample, vec_id % 8 AS channel, list_transform(w, lambda v: v - list_sum(w) / len(w)) AS w FROM x),
    g AS (SELECT first_sample, channel, k, pow({CK}, 2) + pow({SK}, 2) AS v FROM c, (SELECT unnest(range(32)) AS k)), l AS (SELECT first_sample, channel, median(v) AS l FROM g WHERE k > 0 GROUP BY ALL),
    n AS (SELECT first_sample, channel, k, v / l AS v FROM g JOIN l USING (first_sample, channel) WHERE l > 0), m AS (SELECT first_sample, count(DISTINCT channel) AS m FROM n GROUP BY ALL),
    t AS (SELECT first_sample, k, sum(v) AS v FROM n GROUP BY ALL), r AS (SELECT a.first_sample, a.k, 10 * log10(a.v / median(b.v)) AS ratio_db, a.v > max(b.v) AS is_max FROM t a JOIN t b ON a.first_sample = b.first_sample AND abs(a.k - b.k) BETWEEN {GUARD + 1} AND {GUARD + N_BG} WHERE a.k BETWEEN {1 + GUARD + N_BG} AND {31 - GUARD - N_BG} GROUP BY a.first_sample, a.k, a.v),
    o AS (SELECT first_sample, k, count(*) FILTER (WHERE over) AS n_over FROM (SELECT a.first_sample, a.k, a.v > max(b.v) AS over FROM n a JOIN n b ON a.first_sample = b.first_sample AND a.channel = b.channel AND abs(a.k - b.k) BETWEEN {GUARD + 1} AND {GUARD + N_BG} WHERE a.k BETWEEN {1 + GUARD + N_BG} AND {31 - GUARD - N_BG} GROUP BY a.first_sample, a.k, a.channel, a.v) GROUP BY ALL),
    z AS (SELECT m, min(h) AS threshold FROM (SELECT m, h, coalesce(list_sum(list_transform(range(h, m + 1), lambda c: round(exp(lgamma(m + 1) - lgamma(c + 1) - lgamma(m - c + 1))) * pow(1 / 17, c) * pow(16 / 17, m - c))), 0) AS tail FROM (SELECT DISTINCT m, unnest(range(0, m + 2)) AS h FROM m)) WHERE tail <= {ALPHA} GROUP BY m)
    SELECT first_sample, k AS bin, k::DOUBLE AS freq_hz, m AS n_channels, round(ratio_db, 6) AS ratio_db, is_max, n_over, threshold FROM r JOIN o USING (first_sample, k) JOIN m USING (first_sample) JOIN z USING (m) WHERE m >= 3 AND (is_max OR n_over >= threshold)""",
)
def array_detections(spark, d):
    found = detection.detections(detection.frames(recording(spark, d), N_BG, GUARD, ALPHA))
    return rounded(found.select("first_sample", "bin", "freq_hz", "n_channels", "ratio_db", "is_max", "n_over", "threshold"))


#: So many squarings leave the largest eigenvalue of a matrix alone.
SQUARINGS = 40


@query(
    "common_component",
    f"""WITH RECURSIVE {DOUBLES_SQL}, f AS (SELECT vec_id // 128 AS g, vec_id // 8 % 16 AS s, vec_id % 8 AS c, 2 * {C5} / len(w) AS re, -2 * {S5} / len(w) AS im FROM x),
    d AS (SELECT g, c, sqrt(avg(re * re + im * im) - pow(avg(re), 2) - pow(avg(im), 2)) AS d FROM f GROUP BY ALL), n AS (SELECT g, count(DISTINCT s) AS n, count(DISTINCT c) AS m FROM f GROUP BY g),
    y AS (SELECT g, s, dense_rank() OVER (PARTITION BY g ORDER BY c) - 1 AS c, re / d AS re, im / d AS im FROM f JOIN d USING (g, c) WHERE d > 0),
    h AS (SELECT a.g, a.c AS i, b.c AS j, sum(a.re * b.re + a.im * b.im) / n AS re, sum(a.im * b.re - a.re * b.im) / n AS im FROM y a JOIN y b ON a.g = b.g AND a.s = b.s JOIN n ON n.g = a.g GROUP BY a.g, a.c, b.c, n),
    r AS (SELECT g, i, j, re AS v FROM h UNION ALL SELECT g, i + 8, j + 8, re FROM h UNION ALL SELECT g, i, j + 8, -im FROM h UNION ALL SELECT g, i + 8, j, im FROM h),
    q(k, g, i, j, v) AS (SELECT 0, g, i, j, v / sum(CASE WHEN i = j THEN v END) OVER (PARTITION BY g) FROM r
      UNION ALL SELECT k, g, i, j, v / sum(CASE WHEN i = j THEN v END) OVER (PARTITION BY g) FROM (SELECT a.k + 1 AS k, a.g, a.i, b.j, sum(a.v * b.v) AS v FROM q a JOIN q b ON a.g = b.g AND a.j = b.i WHERE a.k < {SQUARINGS} GROUP BY a.k, a.g, a.i, b.j)),
    tops AS (SELECT q.g, sum(q.v * r.v) AS top FROM q JOIN r ON q.g = r.g AND q.i = r.j AND q.j = r.i WHERE q.k = {SQUARINGS} GROUP BY q.g), u AS (SELECT g, sum(v) / 2 AS trace FROM r WHERE i = j GROUP BY g),
    v AS (SELECT g, 1 / sum(s * s) AS participation FROM (SELECT g, i % 8 AS c, sum(v) AS s FROM q WHERE k = {SQUARINGS} AND i = j GROUP BY ALL) GROUP BY g)
    SELECT g, m AS n_channels, n AS n_snapshots, round(top * m / trace, 6) AS statistic, round(participation, 6) AS participation, round(pow(1 + sqrt(m / n), 2), 6) AS edge,
    m >= 3 AND n >= 4 AND top * m / trace >= pow(1 + sqrt(m / n), 2) AND participation >= greatest(3, m / 3) AS shared FROM tops JOIN u USING (g) JOIN v USING (g) JOIN n USING (g)""",
)
def common_component(spark, d):
    w = windows_of(spark, d)
    turn = lambda i: 2 * F.pi() * 5 * i / F.size("w")
    total = lambda f: F.aggregate(F.transform("w", lambda v, i: v * f(turn(i))), F.lit(0.0), lambda s, v: s + v)
    phasors = w.select(F.floor(F.col("vec_id") / 128).alias("g"), (F.floor(F.col("vec_id") / 8) % 16).alias("s"), (F.col("vec_id") % 8).alias("channel"), (2 * total(F.cos) / F.size("w")).alias("re"), (-2 * total(F.sin) / F.size("w")).alias("im"))
    return rounded(detection.rank_one(phasors, ["g"], "s").select("g", "n_channels", "n_snapshots", "statistic", "participation", "edge", "shared"))


def line_sql(k: int) -> str:
    """A line through ln f over the rungs nearest to the line before."""
    return f"l{k + 1} AS (SELECT card, n, regr_slope(y, r) AS b, regr_intercept(y, r) AS a FROM (SELECT card, n, y, round((y - a) / b) AS r FROM f JOIN l{k} USING (card)) GROUP BY ALL)"


@query(
    "recovered_ladder",
    f"""WITH f AS (SELECT DISTINCT card, ln(area * area) AS y FROM p), t AS (SELECT card, c, 2 + c * 0.05::DOUBLE AS d, avg(cos(2 * pi() * y * (2 + c * 0.05::DOUBLE) / ln(10))) AS re, avg(sin(2 * pi() * y * (2 + c * 0.05::DOUBLE) / ln(10))) AS im, count(*) AS n FROM f, (SELECT unnest(range(361)) AS c) GROUP BY ALL),
    r AS (SELECT *, sqrt(re * re + im * im) AS r FROM t), k AS (SELECT *, max(r) OVER (PARTITION BY card) AS top, r >= coalesce(lag(r) OVER w, 0) AND r >= coalesce(lead(r) OVER w, 0) AS peak FROM r WINDOW w AS (PARTITION BY card ORDER BY c)),
    s AS (SELECT card, min(c) AS c FROM k WHERE peak AND r >= 0.9 * top GROUP BY card), l0 AS (SELECT card, n, ln(10) / d AS b, ln(10) / d * atan2(im, re) / (2 * pi()) AS a FROM r JOIN s USING (card, c)), {line_sql(0)}, {line_sql(1)}
    SELECT card, round(ln(10) / b, 6) AS per_decade, round(a, 6) AS log_f0, round(b, 6) AS log_ratio, n AS n_steps, round(median(abs(exp(y - a - b * round((y - a) / b)) - 1)), 6) AS residual FROM f JOIN l2 USING (card) WHERE n >= 5 AND b > 0 GROUP BY card, a, b, n""",
)
def recovered_ladder(spark, d):
    steps = points(spark, d).select("card", (F.col("area") * F.col("area")).alias("f"))
    return rounded(detection.ladder(steps, ["card"], "f", (2.0, 20.0), 0.05))


@query("recovered_schedule")
def recovered_schedule(spark, d):
    return rounded(detection.recovered_schedule(recording(spark, d), 10.0, 22.0, n_bg=N_BG, guard=GUARD))


#: Hours that a card may run behind another, and hours beside a peak that don't count as its surroundings.
MAX_LAG, BESIDE = 48, 3
HOURS_SQL = (
    "h AS (SELECT card, t_us // 3600000000 AS hour, sum(value) AS v FROM e WHERE value IS NOT NULL GROUP BY ALL), y AS (SELECT card, hour, v - avg(v) OVER (PARTITION BY card) AS v FROM h), "
    f"r AS (SELECT a.card AS a, b.card AS b, b.hour - a.hour AS lag, sum(a.v * b.v) AS r FROM y a JOIN y b ON a.card < b.card AND b.hour - a.hour BETWEEN -{MAX_LAG} AND {MAX_LAG} GROUP BY ALL), z AS (SELECT a, b, lag, coalesce(r, 0) AS r FROM (SELECT a, b, lag FROM (SELECT DISTINCT a, b FROM r), (SELECT unnest(range(-{MAX_LAG}, {MAX_LAG + 1})) AS lag)) l LEFT JOIN r USING (a, b, lag)), "
    "k AS (SELECT a, b, arg_min(lag, (-abs(r), lag)) AS lag, arg_min(r, (-abs(r), lag)) AS r FROM z GROUP BY ALL), e2 AS (SELECT card, sum(v * v) AS e FROM y GROUP BY card), "
    f"q AS (SELECT k.a, k.b, k.lag, k.r / sqrt(ea.e * eb.e) AS correlation, abs(k.r) / median(abs(z.r)) AS prominence FROM k JOIN e2 ea ON ea.card = k.a JOIN e2 eb ON eb.card = k.b JOIN z ON z.a = k.a AND z.b = k.b AND abs(z.lag - k.lag) > {BESIDE} GROUP BY k.a, k.b, k.lag, k.r, ea.e, eb.e)"
)


def hourly(spark, d):
    """The sum of each card's values an hour, less its mean hour, in chunks of a day."""
    e = events(spark, d).where(F.col("value").isNotNull())
    h = e.groupBy("card", F.floor(F.col("t_us") / 3_600_000_000).alias("hour")).agg(F.sum("value").alias("v"))
    # an hour a row: the window is as long as the record, not as many events
    centred = h.withColumn("v", F.col("v") - F.avg("v").over(Window.partitionBy("card")))
    day = centred.groupBy("card", F.floor(F.col("hour") / 24).alias("day")).agg(F.map_from_entries(F.collect_list(F.struct((F.col("hour") % 24).cast("int"), "v"))).alias("m"))
    return day.select("card", (F.col("day") * 24).alias("first_sample"), F.transform(F.sequence(F.lit(0), F.lit(23)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("samples"))


def hourly_lags(spark, d):
    return lags.closures(lags.pair_lags(lags.pair_correlations(hourly(spark, d), MAX_LAG, 24 * 14, centre=False), MAX_LAG, BESIDE))


@query(
    "card_pair_lags",
    f"""WITH {HOURS_SQL}, w AS (SELECT a AS p, b AS q, lag FROM q UNION ALL SELECT b, a, -lag FROM q), c AS (SELECT q.a, q.b, median(abs(q.lag + u.lag - v.lag)) AS closure FROM q JOIN w u ON u.p = q.b JOIN w v ON v.p = q.a AND v.q = u.q GROUP BY ALL)
    SELECT a, b, lag, round(correlation, 6) AS correlation, round(prominence, 6) AS prominence, closure FROM q LEFT JOIN c USING (a, b)""",
)
def card_pair_lags(spark, d):
    return rounded(hourly_lags(spark, d))


@query("card_lags")
def card_lags(spark, d):
    return rounded(lags.card_lags(hourly_lags(spark, d), 6.0, 0.0))
