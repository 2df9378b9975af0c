"""Operators over time-ordered samples (events as channels of cards)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import aggregate, gates, joins, robust, windows
from .registry import events, query, rounded, table

DAY = 86_400_000_000


def seconds(df, digits: int = 6):
    return df.withColumn("t", F.round(F.col("t_us") / 1e6, digits))


@query(
    "plate_from_points",
    """WITH m AS (SELECT card, segment, median(value) AS mid FROM e GROUP BY ALL), s AS (SELECT e.*, mid, median(abs(value - mid)) OVER (PARTITION BY e.card, e.segment) AS mad FROM e JOIN m USING (card, segment)),
    k AS (SELECT card, segment, value, CASE WHEN NOT value > 0.05 THEN 'too_small' WHEN NOT abs(value - mid) <= 4 * 1.4826 * mad THEN 'outlier' ELSE '' END AS reason FROM s),
    a AS (SELECT card, segment, median(CASE WHEN reason = '' THEN value END) AS r, count(*) FILTER (WHERE reason = '') AS n_kept, count(*) FILTER (WHERE reason = 'outlier') AS n_outliers FROM k GROUP BY ALL)
    SELECT card, count(*) AS n_segments, round(sum(1.0 + segment % 5) / sum((1.0 + segment % 5) / r), 6) AS r_plate, sum(n_kept)::BIGINT AS n_kept, sum(n_outliers)::BIGINT AS n_outliers FROM a WHERE r > 0 GROUP BY card""",
)
def plate_from_points(spark, d):
    channel = Window.partitionBy("card", "segment")
    # one shuffle by channel serves both medians and the aggregate
    marked = events(spark, d).select("card", "segment", "value", F.median("value").over(channel).alias("mid"))
    marked = marked.withColumn("mad", F.median(F.abs(F.col("value") - F.col("mid"))).over(channel))
    kept = gates.ledger(marked, [("too_small", F.col("value") > 0.05), ("outlier", F.abs(F.col("value") - F.col("mid")) <= 4 * robust.MAD_SIGMA * F.col("mad"))])
    segments = kept.groupBy("card", "segment").agg(F.median(F.when(F.col("kept"), F.col("value"))).alias("r"), F.count_if("kept").alias("n_kept"), F.count_if(F.col("reason") == "outlier").alias("n_outliers")).where("r > 0")
    area = 1.0 + F.col("segment") % 5
    return segments.groupBy("card").agg(F.count(F.lit(1)).alias("n_segments"), F.round(F.sum(area) / F.sum(area / F.col("r")), 6).alias("r_plate"), F.sum("n_kept").alias("n_kept"), F.sum("n_outliers").alias("n_outliers"))


@query("band_gate", "SELECT event_id, card, value FROM e WHERE value BETWEEN 5 AND 20 AND segment >= 10")
def band_gate(spark, d):
    return events(spark, d).where(gates.band("value", 5, 20) & (F.col("segment") >= 10)).select("event_id", "card", "value")


@query("ac_rms_health", "SELECT card, segment, round(stddev_pop(value), 9) AS rms, count(*) AS n FROM e GROUP BY ALL")
def ac_rms_health(spark, d):
    return events(spark, d).groupBy("card", "segment").agg(F.round(aggregate.ac_rms("value"), 9).alias("rms"), F.count(F.lit(1)).alias("n"))


@query("healthiest_reference", "WITH r AS (SELECT card, segment, stddev_pop(value) AS rms FROM e GROUP BY ALL) SELECT card, coalesce(max(CASE WHEN segment = 7 AND rms > 15 THEN segment END), arg_max(segment, rms)) AS reference, round(max(rms), 9) AS rms FROM r GROUP BY card")
def healthiest_reference(spark, d):
    r = events(spark, d).groupBy("card", "segment").agg(aggregate.ac_rms("value").alias("rms"))
    named = F.max(F.when((F.col("segment") == 7) & (F.col("rms") > 15), F.col("segment")))
    return r.groupBy("card").agg(F.coalesce(named, F.max_by("segment", "rms")).alias("reference"), F.round(F.max("rms"), 9).alias("rms"))


BANDS = {"low": (0.0, 5.0), "mid": (5.0, 20.0), "high": (20.0, 1e9)}


@query(
    "card_factors_banded",
    """WITH f AS (SELECT card, segment, CAST(segment AS DOUBLE) AS step, value FROM e WHERE value > 0), r AS (SELECT step, median(value) AS plate FROM f GROUP BY step),
    l AS (SELECT card, CASE WHEN step < 5 THEN 'low' WHEN step < 20 THEN 'mid' ELSE 'high' END AS band, ln(value / plate) AS x FROM f JOIN r USING (step))
    SELECT card, band, count(*) AS n, round(CASE WHEN count(*) >= 3 THEN 100 * (exp(median(x)) - 1) END, 6) AS factor_pct FROM l GROUP BY ALL""",
)
def card_factors_banded(spark, d):
    e = events(spark, d).where("value > 0").withColumn("step", F.col("segment").cast("double"))
    return rounded(aggregate.card_factors(e, "card", "step", "value", BANDS))


@query("repeat_drift_first_last", "WITH f AS (SELECT card, segment, arg_min(value, (t_us, event_id)) AS a, arg_max(value, (t_us, event_id)) AS b FROM e GROUP BY ALL) SELECT card, segment, a AS first, b AS last, round(100 * (b - a) / CASE WHEN a <> 0 THEN a END, 6) AS change_pct FROM f")
def repeat_drift_first_last(spark, d):
    e = events(spark, d).withColumn("at", F.struct("t_us", "event_id"))
    return rounded(windows.first_last(e, ["card", "segment"], "at", "value"))


@query(
    "mad_modified_z",
    """WITH m AS (SELECT card, segment, median(value) AS median, count(value) AS n, (max(value) - min(value)) / 2 AS half FROM e GROUP BY ALL), s AS (SELECT card, segment, median(abs(value - median)) AS mad FROM e JOIN m USING (card, segment) GROUP BY ALL)
    SELECT event_id, round((value - median) / CASE WHEN mad > 0 THEN mad / 0.6745 WHEN half > 0 THEN half END, 6) AS z FROM e JOIN m USING (card, segment) JOIN s USING (card, segment)
    WHERE n >= 2 AND abs((value - median) / CASE WHEN mad > 0 THEN mad / 0.6745 WHEN half > 0 THEN half END) >= 3.5""",
)
def mad_modified_z(spark, d):
    z = robust.modified_z(events(spark, d), ["card", "segment"], "value")
    return z.where(F.abs("z") >= 3.5).select("event_id", F.round("z", 6).alias("z"))


@query(
    "moving_median_outliers",
    """WITH y AS (SELECT event_id, card, segment, t_us, log10(value) AS y FROM e WHERE value > 0), n AS (SELECT *, list_concat(list(y) OVER (PARTITION BY card, segment ORDER BY t_us, event_id ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), list(y) OVER (PARTITION BY card, segment ORDER BY t_us, event_id ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING)) AS nb FROM y),
    r AS (SELECT *, y - coalesce(list_median(nb), y) AS resid FROM n), c AS (SELECT card, segment, median(resid) AS m, count(*) AS n FROM r GROUP BY ALL), s AS (SELECT card, segment, median(abs(resid - m)) AS mad, max(n) AS n FROM r JOIN c USING (card, segment) GROUP BY ALL)
    SELECT event_id, round(resid, 9) AS resid FROM r JOIN s USING (card, segment) WHERE n >= 5 AND abs(resid) > 4 * greatest(0.02, 1.4826 * mad)""",
)
def moving_median_outliers(spark, d):
    e = events(spark, d).where("value > 0").withColumn("y", F.log10("value"))
    return robust.moving_outliers(e, ["card", "segment"], ["t_us", "event_id"], "y").where("outlier").select("event_id", F.round("resid", 9).alias("resid"))


@query(
    "neighbour_p75_drop",
    """WITH n AS (SELECT *, list_concat(list(value) OVER (PARTITION BY card, segment ORDER BY t_us, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), list(value) OVER (PARTITION BY card, segment ORDER BY t_us, event_id ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)) AS nb FROM e)
    SELECT event_id, round(list_aggregate(nb, 'quantile_cont', 0.75), 6) AS level FROM n WHERE len(nb) >= 3 AND value < list_aggregate(nb, 'quantile_cont', 0.75) - 40""",
)
def neighbour_p75_drop(spark, d):
    e = events(spark, d)
    e = e.withColumn("level", robust.neighbour_level(e, ["card", "segment"], ["t_us", "event_id"], "value"))
    return e.where(F.col("value") < F.col("level") - 40).select("event_id", F.round("level", 6).alias("level"))


@query(
    "theil_sen_slope",
    """WITH b AS (SELECT card, CAST(t_us // 86400000000 AS DOUBLE) AS day, avg(value) AS v FROM e GROUP BY ALL)
    SELECT a.card, round(median((b.v - a.v) / (b.day - a.day)), 9) AS slope, count(*) AS n_pairs FROM b a JOIN b b ON a.card = b.card AND a.day < b.day GROUP BY a.card""",
)
def theil_sen_slope(spark, d):
    blocks = events(spark, d).groupBy("card", F.floor(F.col("t_us") / DAY).cast("double").alias("day")).agg(F.avg("value").alias("v"))
    return rounded(robust.theil_sen(blocks, ["card"], "day", "v"), 9)


@query(
    "closure_triplets",
    """WITH m AS (SELECT card, t_us // 86400000000 AS day, avg(value) AS v FROM e GROUP BY ALL), t AS (SELECT a.card AS a, b.card AS b, median(b.v - a.v) AS tau FROM m a JOIN m b ON a.day = b.day AND a.card < b.card GROUP BY ALL)
    SELECT ab.a AS a, ab.b AS b, bc.b AS c, round(ab.tau + bc.tau - ac.tau, 9) AS residual FROM t ab JOIN t bc ON ab.b = bc.a JOIN t ac ON ac.a = ab.a AND ac.b = bc.b""",
)
def closure_triplets(spark, d):
    m = events(spark, d).groupBy("card", F.floor(F.col("t_us") / DAY).alias("day")).agg(F.avg("value").alias("v"))
    x, y = m.select(F.col("card").alias("a"), "day", F.col("v").alias("va")), m.select(F.col("card").alias("b"), "day", F.col("v").alias("vb"))
    tau = x.join(y, "day").where("a < b").groupBy("a", "b").agg(F.median(F.col("vb") - F.col("va")).alias("tau"))
    ab, bc, ac = tau.withColumnRenamed("tau", "ab"), tau.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("tau").alias("bc")), tau.select("a", F.col("b").alias("c"), F.col("tau").alias("ac"))
    return ab.join(bc, "b").join(ac, ["a", "c"]).select("a", "b", "c", F.round(F.col("ab") + F.col("bc") - F.col("ac"), 9).alias("residual"))


@query(
    "runs_of_true",
    """WITH o AS (SELECT card, event_id, t_us, row_number() OVER (PARTITION BY card ORDER BY t_us, event_id) AS n, value > 20 AS f FROM e), i AS (SELECT *, n - row_number() OVER (PARTITION BY card ORDER BY n) AS island FROM o WHERE f)
    SELECT card, min(n) AS first, max(n) AS last, count(*) AS n_rows FROM i GROUP BY card, island""",
)
def runs_of_true(spark, d):
    out = windows.runs_of_true(events(spark, d), ["card"], ["t_us", "event_id"], F.col("value") > 20, F.floor(F.col("t_us") / DAY))
    return out.select("card", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), "n_rows")


@query(
    "decimate_minmax",
    """WITH b AS (SELECT card, t_us // 86400000000 AS bucket, min((value, t_us)) AS lo, max((value, -t_us)) AS hi FROM e GROUP BY ALL)
    SELECT DISTINCT card, bucket, t_us, value FROM (SELECT card, bucket, lo[2] AS t_us, lo[1] AS value FROM b UNION ALL SELECT card, bucket, -hi[2], hi[1] FROM b)""",
)
def decimate_minmax(spark, d):
    return windows.decimate(events(spark, d), ["card"], "t_us", "value", F.floor(F.col("t_us") / DAY)).select("card", "bucket", "t_us", "value")


@query(
    "sample_repeats_gaps",
    """WITH l AS (SELECT card, t - lag(t) OVER w AS dt, value <> lag(value) OVER w AS other FROM (SELECT card, t_us // 60000000 AS t, value FROM e) WINDOW w AS (PARTITION BY card ORDER BY t, value))
    SELECT card, count(*) AS n_samples, count(*) FILTER (WHERE dt = 0) AS n_repeats, count(*) FILTER (WHERE dt = 0 AND other) AS n_conflicts, count(*) FILTER (WHERE dt > 60) AS n_gaps, max(dt) AS longest_gap FROM l GROUP BY card""",
)
def sample_repeats_gaps(spark, d):
    e = events(spark, d).withColumn("t", F.floor(F.col("t_us") / 60_000_000))
    return windows.repeats_and_gaps(e, ["card"], "t", "value", 60, F.floor(F.col("t") / 1440))


@query(
    "asof_reference",
    """WITH s AS (SELECT event_id, segment, t_us, value FROM e WHERE card = 'click'), r AS (SELECT segment, t_us, max(value) AS reference FROM e WHERE card = 'view' GROUP BY ALL)
    SELECT s.event_id, s.value, r.reference FROM s ASOF LEFT JOIN r ON s.segment = r.segment AND s.t_us >= r.t_us""",
)
def asof_reference(spark, d):
    e = events(spark, d)
    left = e.where("card = 'click'").select("event_id", "segment", "t_us", "value")
    right = e.where("card = 'view'").select("segment", "t_us", F.col("value").alias("reference"))
    return joins.asof(left, right, ["segment"], "t_us", ["reference"]).select("event_id", "value", "reference")


@query("nearest_point", "SELECT card, segment, arg_min(value, (abs(ln(value / 10)), value, event_id)) AS value, arg_min(event_id, (abs(ln(value / 10)), value, event_id)) AS event_id, round(min(abs(ln(value / 10))), 9) AS distance FROM e WHERE value > 0 GROUP BY ALL")
def nearest_point(spark, d):
    e = events(spark, d).where("value > 0")
    return rounded(joins.nearest(e, ["card", "segment"], F.abs(F.ln(F.col("value") / 10)), ["value", "event_id"]), 9)


@query(
    "window_sample_range_join",
    """WITH w AS (SELECT event_id AS window_id, segment, t_us AS start, t_us + 7200000000 + event_id % 7 * 600000000 AS stop FROM e WHERE card = 'signup')
    SELECT window_id, count(*) AS n, round(sum(e.value), 6) AS total FROM w JOIN e ON e.segment = w.segment AND e.t_us >= w.start AND e.t_us < w.stop WHERE e.card <> 'signup' GROUP BY window_id""",
)
def window_sample_range_join(spark, d):
    e = events(spark, d)
    w = e.where("card = 'signup'").select(F.col("event_id").alias("window_id"), "segment", F.col("t_us").alias("start"), (F.col("t_us") + 7_200_000_000 + F.col("event_id") % 7 * 600_000_000).alias("stop"))
    found = joins.in_ranges(e.where("card <> 'signup'").select("segment", "t_us", "value"), w, ["segment"], "t_us", "start", "stop", 7_200_000_000)
    return found.groupBy("window_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query(
    "interval_gap_select",
    """WITH o AS (SELECT segment, t_us, CASE WHEN t_us - lag(t_us) OVER (PARTITION BY segment ORDER BY t_us) > 7200000000 THEN 1 ELSE 0 END AS new FROM e WHERE card <> 'error'), c AS (SELECT *, sum(new) OVER (PARTITION BY segment ORDER BY t_us) AS session FROM o),
    i AS (SELECT segment, session, min(t_us) AS start, max(t_us) AS stop FROM c GROUP BY ALL), t AS (SELECT event_id, segment, t_us FROM e WHERE card = 'error'),
    g AS (SELECT t.*, i.start, greatest(0, i.start - t.t_us, t.t_us - i.stop) AS gap FROM t JOIN i USING (segment)), k AS (SELECT *, min(gap) OVER (PARTITION BY event_id) AS least FROM g WHERE gap <= 14400000000),
    pk AS (SELECT event_id, count(*) AS n_nearest, min(start) AS start, min(gap) AS gap FROM k WHERE gap = least GROUP BY event_id)
    SELECT t.event_id, coalesce(n_nearest, 0) AS n_nearest, CASE WHEN n_nearest = 1 THEN start END AS start, CASE WHEN n_nearest = 1 THEN gap END AS gap FROM t LEFT JOIN pk USING (event_id)""",
)
def interval_gap_select(spark, d):
    e = events(spark, d)
    spans = windows.sessions(e.where("card <> 'error'"), ["segment"], "t_us", 7_200_000_000).select("segment", "start", "stop")
    times = e.where("card = 'error'").select("event_id", "segment", "t_us")
    gap = joins.nearest_interval(times, spans, ["segment"], "t_us", "start", "stop", 14_400_000_000.0, ["start"])
    return gap.select("event_id", "n_nearest", "start", F.col("gap").cast("long").alias("gap"))


@query(
    "state_at_median_or_hold",
    """WITH w AS (SELECT event_id, segment, t_us FROM e WHERE card = 'purchase'), l AS (SELECT segment, t_us, value FROM e WHERE card = 'view'),
    m AS (SELECT w.event_id, median(l.value) AS m, count(l.value) AS n FROM w JOIN l ON l.segment = w.segment AND l.t_us >= w.t_us - 7200000000 AND l.t_us <= w.t_us + 1800000000 GROUP BY w.event_id),
    h AS (SELECT w.event_id, l.value AS hold FROM w ASOF LEFT JOIN l ON w.segment = l.segment AND w.t_us + 1800000000 >= l.t_us)
    SELECT event_id, coalesce(m, hold) AS value, coalesce(n, 0) AS n_near FROM w LEFT JOIN m USING (event_id) LEFT JOIN h USING (event_id)""",
)
def state_at_median_or_hold(spark, d):
    e = events(spark, d)
    times = e.where("card = 'purchase'").select("event_id", "segment", "t_us")
    log = e.where("card = 'view'").select("segment", "t_us", "value")
    return joins.state_at(times, log, ["segment"], "t_us", "value", 7_200_000_000, 1_800_000_000).select("event_id", "value", "n_near")


@query(
    "file_catalogue_first_nonnull",
    "SELECT segment AS file_id, arg_min(card, event_id) FILTER (WHERE value > 50) AS channel, min(event_id) FILTER (WHERE value > 50) AS first_id, count(*) AS n, coalesce(max(quality), -1) AS quality FROM e LEFT JOIN labels ON doc_id = segment GROUP BY segment",
)
def file_catalogue_first_nonnull(spark, d):
    e = events(spark, d).join(table(spark, d, "labels").select(F.col("doc_id").alias("segment"), "quality"), "segment", "left")
    large = F.when(F.col("value") > 50, F.col("event_id"))
    return e.groupBy(F.col("segment").alias("file_id")).agg(F.min_by("card", large).alias("channel"), F.min(large).alias("first_id"), F.count(F.lit(1)).alias("n"), F.coalesce(F.max("quality"), F.lit(-1)).alias("quality"))


@query(
    "long_to_wide_pivot",
    """WITH f AS (SELECT segment, card, arg_min(value, event_id) AS v FROM e GROUP BY ALL)
    SELECT segment, max(v) FILTER (WHERE card = 'click') AS click, max(v) FILTER (WHERE card = 'view') AS view, max(v) FILTER (WHERE card = 'error') AS error FROM f GROUP BY segment
    HAVING count(*) FILTER (WHERE card = 'click') > 0 AND count(*) FILTER (WHERE card = 'view') > 0 AND count(*) FILTER (WHERE card = 'error') > 0""",
)
def long_to_wide_pivot(spark, d):
    names = ["click", "view", "error"]
    return events(spark, d).groupBy("segment").pivot("card", names).agg(F.min_by("value", "event_id")).na.drop(subset=names)


@query("cards_of_five_by_minute", "SELECT t_us // 3600000000 AS hour, string_agg(DISTINCT card, ',' ORDER BY card) AS cards, count(*) AS n, min(event_id) AS first_event FROM e GROUP BY 1 HAVING count(DISTINCT card) = 5")
def cards_of_five_by_minute(spark, d):
    hour = F.floor(F.col("t_us") / 3_600_000_000)
    return events(spark, d).groupBy(hour.alias("hour")).agg(F.array_join(F.array_sort(F.collect_set("card")), ",").alias("cards"), F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event")).where(F.size(F.split("cards", ",")) == 5)


@query("channel_profile", "SELECT card, segment, count(*) AS n, min(t_us) AS t_min, max(t_us) AS t_max, round(count(*) / ((max(t_us) - min(t_us)) / 1e6), 12) AS fs FROM e GROUP BY ALL HAVING max(t_us) > min(t_us)")
def channel_profile(spark, d):
    out = events(spark, d).groupBy("card", "segment").agg(F.count(F.lit(1)).alias("n"), F.min("t_us").alias("t_min"), F.max("t_us").alias("t_max")).where("t_max > t_min")
    return out.withColumn("fs", F.round(F.col("n") / ((F.col("t_max") - F.col("t_min")) / 1e6), 12))


@query("manifest_json_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, substr(sha256(props), 1, 16) AS digest FROM e")
def manifest_json_extract(spark, d):
    e = events(spark, d)
    return e.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.substring(F.sha2("props", 256), 1, 16).alias("digest"))


@query(
    "zero_crossing",
    """WITH c AS (SELECT card, segment, event_id, t_us, value - 20 AS im, value * 2 AS re, lead(value - 20) OVER w AS im2, lead(value * 2) OVER w AS re2 FROM e WINDOW w AS (PARTITION BY card, segment ORDER BY event_id))
    SELECT card, segment, round(arg_min(re + im / (im - im2) * (re2 - re), event_id) FILTER (WHERE im < 0 AND im2 >= 0), 6) AS crossing, count(*) FILTER (WHERE im < 0 AND im2 >= 0) AS n_crossings FROM c GROUP BY ALL""",
)
def zero_crossing(spark, d):
    e = events(spark, d).select("card", "segment", "event_id", (F.col("value") - 20).alias("im"), (F.col("value") * 2).alias("re"))
    return rounded(windows.crossing(e, ["card", "segment"], "event_id", "re", "im"))


@query(
    "stationarity_halves",
    """WITH h AS (SELECT card, segment, value, ntile(2) OVER (PARTITION BY card, segment ORDER BY t_us, event_id) AS half FROM e), m AS (SELECT card, segment, avg(value) FILTER (WHERE half = 1) AS a, avg(value) FILTER (WHERE half = 2) AS b FROM h GROUP BY ALL)
    SELECT card, round(max(abs(b - a) / abs(a)), 9) AS max_change, round(median(abs(b - a) / abs(a)), 9) AS median_change, count(*) AS n_keys FROM m GROUP BY card""",
)
def stationarity_halves(spark, d):
    return rounded(windows.halves(events(spark, d), ["card"], "segment", ["t_us", "event_id"], "value"), 9)


@query("robust_limits", "SELECT card, round(quantile_cont(value, 0.02), 9) AS low, round(quantile_cont(value, 0.98), 9) AS high FROM e GROUP BY card")
def robust_limits(spark, d):
    q = robust.quantiles(events(spark, d), ["card"], "value", [0.02, 0.98])
    return rounded(q.groupBy("card").agg(*[F.max(F.when(F.col("share") == s, F.col("quantile"))).alias(name) for s, name in ((0.02, "low"), (0.98, "high"))]), 9)


@query(
    "regularity_jitter",
    """WITH s AS (SELECT card, t_us - lag(t_us) OVER (PARTITION BY card ORDER BY t_us) AS dt FROM e), m AS (SELECT card, median(dt) AS mid, max(dt) AS most FROM s WHERE dt IS NOT NULL GROUP BY card), j AS (SELECT card, mid, most, median(abs(dt - mid)) AS mad FROM s JOIN m USING (card) WHERE dt IS NOT NULL GROUP BY ALL)
    SELECT card, mid AS dt, round(1.4826 * mad / mid, 9) AS jitter, round(most / mid, 9) AS max_gap, (1.4826 * mad / mid < 0.001 AND most / mid < 1.5) AS uniform FROM j""",
)
def regularity_jitter(spark, d):
    out = robust.regularity(events(spark, d), ["card"], "t_us", bucket=F.floor(F.col("t_us") / DAY))
    return out.select("card", "dt", F.round("jitter", 9).alias("jitter"), F.round("max_gap", 9).alias("max_gap"), "uniform")


@query(
    "quantisation_step",
    "WITH v AS (SELECT DISTINCT card, round(value, 12) AS v FROM e), s AS (SELECT card, v - lag(v) OVER (PARTITION BY card ORDER BY v) AS d FROM v) SELECT card, round(min(d) FILTER (WHERE d > 0), 9) AS step, count(*) AS n_levels FROM s GROUP BY card",
)
def quantisation_step(spark, d):
    return rounded(robust.quantisation_step(events(spark, d), ["card"], "value", bucket=1.0), 9)


@query("finite_stats", "SELECT card, count(value) AS n, round(avg(value), 9) AS mean, round(stddev_pop(value), 9) AS sd, round(stddev_pop(value) / avg(value), 9) AS cv, min(value) AS min, max(value) AS max, median(value) AS median FROM e GROUP BY card")
def finite_stats(spark, d):
    e = events(spark, d)
    middle = robust.quantiles(e, ["card"], "value", [0.5]).select("card", F.col("quantile").alias("median"))
    return rounded(e.groupBy("card").agg(*robust.finite_stats("value")[:-1]).join(middle, "card", "left"), 9)


@query(
    "moving_mean",
    "SELECT event_id, round(avg(value) OVER (PARTITION BY card, segment ORDER BY t_us, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 9) AS smooth FROM e",
)
def moving_mean(spark, d):
    w = Window.partitionBy("card", "segment").orderBy("t_us", "event_id").rowsBetween(-3, 3)
    return events(spark, d).select("event_id", F.round(F.avg("value").over(w), 9).alias("smooth"))
