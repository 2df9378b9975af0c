"""Smaller operators of the evaluation: gains with a fallback, overlaps, ladders, intercepts, alignment, renumbering."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import joins
from .registry import events, points, query, rounded
from .table_queries import PADS_SQL, pads


@query(
    "gain_with_fallback",
    """WITH g AS (SELECT segment, freq_hz, avg(thd) AS own FROM p WHERE segment % 3 = 0 GROUP BY ALL), s AS (SELECT freq_hz, avg(thd) AS shared FROM p GROUP BY freq_hz), v AS (SELECT segment, freq_hz, avg(z_re) AS z FROM p GROUP BY ALL)
    SELECT segment, freq_hz, round(z / (1 + coalesce(own, shared)), 6) AS z FROM v LEFT JOIN g USING (segment, freq_hz) LEFT JOIN s USING (freq_hz)""",
)
def gain_with_fallback(spark, d):
    p = points(spark, d)
    own = p.where("segment % 3 = 0").groupBy("segment", "freq_hz").agg(F.avg("thd").alias("own"))
    shared = p.groupBy("freq_hz").agg(F.avg("thd").alias("shared"))
    values = p.groupBy("segment", "freq_hz").agg(F.avg("z_re").alias("z"))
    out = values.join(own, ["segment", "freq_hz"], "left").join(shared, "freq_hz", "left")
    return out.select("segment", "freq_hz", F.round(F.col("z") / (1 + F.coalesce("own", "shared")), 6).alias("z"))


@query(
    "overlap_compare",
    """WITH a AS (SELECT card, freq_hz, avg(z_re) AS za FROM p WHERE flag = 'A' AND freq_hz BETWEEN 10 AND 70 GROUP BY ALL), b AS (SELECT card, freq_hz, avg(z_re) AS zb FROM p WHERE flag = 'R' AND freq_hz BETWEEN 25 AND 80 GROUP BY ALL),
    o AS (SELECT card, greatest((SELECT min(freq_hz) FROM a x WHERE x.card = c.card), (SELECT min(freq_hz) FROM b x WHERE x.card = c.card)) AS lo, least((SELECT max(freq_hz) FROM a x WHERE x.card = c.card), (SELECT max(freq_hz) FROM b x WHERE x.card = c.card)) AS hi FROM (SELECT DISTINCT card FROM p) c)
    SELECT card, count(*) AS n, round(median(100 * (za / zb - 1)), 6) AS deviation_pct, round(max(abs(20 * log10(za / zb))), 6) AS worst_db FROM a JOIN b USING (card, freq_hz) JOIN o USING (card) WHERE freq_hz BETWEEN lo AND hi GROUP BY card""",
)
def overlap_compare(spark, d):
    p = points(spark, d)
    a = p.where("flag = 'A' AND freq_hz BETWEEN 10 AND 70").groupBy("card", "freq_hz").agg(F.avg("z_re").alias("za"))
    b = p.where("flag = 'R' AND freq_hz BETWEEN 25 AND 80").groupBy("card", "freq_hz").agg(F.avg("z_re").alias("zb"))
    span = lambda df, n: df.groupBy("card").agg(F.min("freq_hz").alias(f"lo{n}"), F.max("freq_hz").alias(f"hi{n}"))
    both = a.join(b, ["card", "freq_hz"]).join(span(a, 1), "card").join(span(b, 2), "card")
    both = both.where(F.col("freq_hz").between(F.greatest("lo1", "lo2"), F.least("hi1", "hi2"))).withColumn("ratio", F.col("za") / F.col("zb"))
    return both.groupBy("card").agg(F.count(F.lit(1)).alias("n"), F.round(F.median(100 * (F.col("ratio") - 1)), 6).alias("deviation_pct"), F.round(F.max(F.abs(20 * F.log10("ratio"))), 6).alias("worst_db"))


@query(
    "separate_windows",
    """WITH w AS (SELECT event_id, segment, t_us AS start, t_us + 5400000000 AS stop FROM e WHERE card = 'click'), n AS (SELECT *, lead(start) OVER (PARTITION BY segment ORDER BY start, event_id) AS after FROM w)
    SELECT event_id, start, least(stop, coalesce(after, stop)) AS stop, (after < stop) IS TRUE AS clipped FROM n WHERE least(stop, coalesce(after, stop)) - start >= 600000000""",
)
def separate_windows(spark, d):
    w = events(spark, d).where("card = 'click'").select("event_id", "segment", F.col("t_us").alias("start"), (F.col("t_us") + 5_400_000_000).alias("stop"))
    after = F.lead("start").over(Window.partitionBy("segment").orderBy("start", "event_id"))
    w = w.withColumn("after", after).withColumn("clipped", F.coalesce(F.col("after") < F.col("stop"), F.lit(False))).withColumn("stop", F.least("stop", F.coalesce("after", "stop")))
    return w.where(F.col("stop") - F.col("start") >= 600_000_000).select("event_id", "start", "stop", "clipped")


@query(
    "value_at_frequency",
    """WITH s AS (SELECT segment, freq_hz, avg(z_re) AS z FROM p WHERE freq_hz > 0 GROUP BY ALL), b AS (SELECT segment, max(freq_hz) FILTER (WHERE freq_hz <= 31.5) AS f0, arg_max(z, freq_hz) FILTER (WHERE freq_hz <= 31.5) AS z0, min(freq_hz) FILTER (WHERE freq_hz >= 31.5) AS f1, arg_min(z, freq_hz) FILTER (WHERE freq_hz >= 31.5) AS z1 FROM s GROUP BY segment)
    SELECT segment, round(CASE WHEN log10(f1 / f0) <= 1.0 / 3 THEN CASE WHEN f1 > f0 THEN z0 + (z1 - z0) * (ln(31.5) - ln(f0)) / (ln(f1) - ln(f0)) ELSE z0 END END, 6) AS re_at FROM b""",
)
def value_at_frequency(spark, d):
    s = points(spark, d).where("freq_hz > 0").groupBy("segment", "freq_hz").agg(F.avg("z_re").alias("z"))
    low, high = F.when(F.col("freq_hz") <= 31.5, F.col("freq_hz")), F.when(F.col("freq_hz") >= 31.5, F.col("freq_hz"))
    b = s.groupBy("segment").agg(F.max(low).alias("f0"), F.max_by("z", low).alias("z0"), F.min(high).alias("f1"), F.min_by("z", high).alias("z1"))
    between = F.when(F.col("f1") > F.col("f0"), F.col("z0") + (F.col("z1") - F.col("z0")) * (math.log(31.5) - F.ln("f0")) / (F.ln("f1") - F.ln("f0"))).otherwise(F.col("z0"))
    return b.select("segment", F.round(F.when(F.log10(F.col("f1") / F.col("f0")) <= 1.0 / 3, between), 6).alias("re_at"))


@query(
    "axis_intercept_fit",
    """WITH s AS (SELECT segment, freq_hz, avg(z_re) AS re, avg(z_im) AS im FROM p GROUP BY ALL), t AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY freq_hz DESC) AS rank FROM s)
    SELECT segment, round(regr_intercept(re, im), 5) AS r_axis, round(regr_r2(re, im), 6) AS r2 FROM t WHERE rank <= 6 GROUP BY segment""",
)
def axis_intercept_fit(spark, d):
    s = points(spark, d).groupBy("segment", "freq_hz").agg(F.avg("z_re").alias("re"), F.avg("z_im").alias("im"))
    top = s.withColumn("rank", F.row_number().over(Window.partitionBy("segment").orderBy(F.desc("freq_hz")))).where("rank <= 6")
    return top.groupBy("segment").agg(F.round(F.regr_intercept("re", "im"), 5).alias("r_axis"), F.round(F.regr_r2("re", "im"), 6).alias("r2"))


@query(
    "card_hf_phase",
    """WITH q AS (SELECT card, freq_hz, atan2(z_im, z_re) AS ph FROM p WHERE freq_hz >= 40), m AS (SELECT freq_hz, median(ph) AS plate FROM q GROUP BY freq_hz HAVING count(*) >= 6), c AS (SELECT card, freq_hz, median(ph) AS own, count(*) AS n FROM q GROUP BY ALL HAVING count(*) >= 3)
    SELECT card, freq_hz, round(degrees(own - plate), 6) AS offset_deg, n FROM c JOIN m USING (freq_hz)""",
)
def card_hf_phase(spark, d):
    q = points(spark, d).where("freq_hz >= 40").select("card", "freq_hz", F.atan2("z_im", "z_re").alias("ph"))
    plate = q.groupBy("freq_hz").agg(F.median("ph").alias("plate"), F.count(F.lit(1)).alias("m")).where("m >= 6")
    own = q.groupBy("card", "freq_hz").agg(F.median("ph").alias("own"), F.count(F.lit(1)).alias("n")).where("n >= 3")
    return own.join(plate, "freq_hz").select("card", "freq_hz", F.round(F.degrees(F.col("own") - F.col("plate")), 6).alias("offset_deg"), "n")


@query(
    "timeline_align",
    """WITH s AS (SELECT segment, t_us, value AS f, event_id FROM e WHERE card = 'click' AND value > 5), l AS (SELECT segment, t_us, value AS f FROM e WHERE card = 'view' AND value > 5),
    v AS (SELECT s.segment, s.event_id, (l.t_us - s.t_us) / 1e6 AS gap FROM s JOIN l ON s.segment = l.segment AND abs(l.f / s.f - 1) <= 0.03), o AS (SELECT segment, median(gap) AS off, count(*) AS n FROM v GROUP BY segment HAVING count(*) >= 5),
    m AS (SELECT segment, median(abs(gap - off)) * 1.4826 AS spread FROM v JOIN o USING (segment) GROUP BY segment)
    SELECT segment, n AS n_voters, round(off, 3) AS offset_s, round(spread, 3) AS spread_s, CASE WHEN spread <= 500000 THEN 'ok' ELSE 'scattered' END AS verdict FROM o JOIN m USING (segment)""",
)
def timeline_align(spark, d):
    e = events(spark, d).where("value > 5")
    s = e.where("card = 'click'").select("segment", F.col("t_us").alias("ts"), F.col("value").alias("fs"))
    log = e.where("card = 'view'").select("segment", F.col("t_us").alias("tl"), F.col("value").alias("fl"))
    votes = joins.within_ratio(s, log, ["segment"], "fs", "fl", 0.03).select("segment", ((F.col("tl") - F.col("ts")) / 1e6).alias("gap"))
    offset = votes.groupBy("segment").agg(F.median("gap").alias("off"), F.count(F.lit(1)).alias("n_voters")).where("n_voters >= 5")
    spread = votes.join(offset, "segment").groupBy("segment").agg((F.median(F.abs(F.col("gap") - F.col("off"))) * 1.4826).alias("spread"))
    out = offset.join(spread, "segment")
    return out.select("segment", "n_voters", F.round("off", 3).alias("offset_s"), F.round("spread", 3).alias("spread_s"), F.when(F.col("spread") <= 500_000, "ok").otherwise("scattered").alias("verdict"))


@query(
    "renumber_nearest_centroid",
    f"""WITH {PADS_SQL}, a AS (SELECT segment, avg(c) AS x, avg(r) AS y FROM pads GROUP BY segment), b AS (SELECT segment + 100 AS other, 44 - avg(c) + segment % 2 AS x, 19 - avg(r) AS y FROM pads GROUP BY segment)
    SELECT a.segment, arg_min(b.other, (round(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)), 9), b.other)) AS other, round(min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))), 6) AS distance FROM a, b GROUP BY a.segment""",
)
def renumber_nearest_centroid(spark, d):
    centre = pads(spark, d).groupBy("segment").agg(F.avg("col").alias("x"), F.avg("row").alias("y"))
    turned = centre.select((F.col("segment") + 100).alias("other"), (44 - F.col("x") + F.col("segment") % 2).alias("x2"), (19 - F.col("y")).alias("y2"))
    # pads() has 36 segments, whatever the table's size
    pairs = centre.join(F.broadcast(turned), F.lit(True))
    away = F.round(F.sqrt(F.pow(F.col("x") - F.col("x2"), 2) + F.pow(F.col("y") - F.col("y2"), 2)), 9)
    return joins.nearest(pairs, ["segment"], away, ["other"]).select("segment", "other", F.round("distance", 6).alias("distance"))


@query(
    "neighbour_contrast",
    f"""WITH {PADS_SQL}, v AS (SELECT segment, avg(c) AS x, avg(r) AS y, avg(p_size) AS v FROM pads GROUP BY segment), n AS (SELECT a.segment, a.v, arg_min(b.v, (round(pow(a.x - b.x, 2) + pow(a.y - b.y, 2), 9), b.segment)) AS near FROM v a JOIN v b ON a.segment <> b.segment GROUP BY ALL)
    SELECT count(*) AS n, round(avg(abs(v - near)) / stddev_samp(v), 6) AS contrast FROM n""",
)
def neighbour_contrast(spark, d):
    v = pads(spark, d).groupBy("segment").agg(F.avg("col").alias("x"), F.avg("row").alias("y"), F.avg("p_size").alias("v"))
    other = v.select(F.col("segment").alias("s2"), F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("v").alias("v2"))
    # pads() has 36 segments, whatever the table's size
    pairs = v.join(F.broadcast(other), F.col("segment") != F.col("s2"))
    away = F.round(F.pow(F.col("x") - F.col("x2"), 2) + F.pow(F.col("y") - F.col("y2"), 2), 9)
    near = joins.nearest(pairs, ["segment", "v"], away, ["s2", "v2"])
    return rounded(near.agg(F.count(F.lit(1)).alias("n"), (F.avg(F.abs(F.col("v") - F.col("v2"))) / F.stddev_samp("v")).alias("contrast")))


@query(
    "coverage_blocks",
    """WITH s AS (SELECT segment // 50 AS plate, segment FROM p GROUP BY segment HAVING avg(snr_db) >= 19.9), i AS (SELECT plate, segment, segment - row_number() OVER (PARTITION BY plate ORDER BY segment) AS island FROM s)
    SELECT plate, min(segment) AS first, max(segment) AS last, count(*) AS n, CASE WHEN count(*) >= 9 THEN 'pass' WHEN count(*) >= 4 THEN 'warn' ELSE 'fail' END AS verdict FROM i GROUP BY plate, island""",
)
def coverage_blocks(spark, d):
    s = points(spark, d).groupBy("segment").agg(F.avg("snr_db").alias("snr")).where("snr >= 19.9").select(F.floor(F.col("segment") / 50).alias("plate"), "segment")
    island = F.col("segment") - F.row_number().over(Window.partitionBy("plate").orderBy("segment"))
    out = s.withColumn("island", island).groupBy("plate", "island").agg(F.min("segment").alias("first"), F.max("segment").alias("last"), F.count(F.lit(1)).alias("n"))
    return out.select("plate", "first", "last", "n", F.when(F.col("n") >= 9, "pass").when(F.col("n") >= 4, "warn").otherwise("fail").alias("verdict"))


@query(
    "plate_subtotals",
    "SELECT card, segment, flag, count(*) AS n, round(avg(z_re), 6) AS r_mean FROM p GROUP BY ROLLUP (card, segment, flag)",
)
def plate_subtotals(spark, d):
    return points(spark, d).rollup("card", "segment", "flag").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("z_re"), 6).alias("r_mean"))


@query("union_of_sources", "SELECT DISTINCT id, kind FROM (SELECT o_orderkey % 500 AS id, 'order' AS kind FROM orders UNION ALL SELECT c_custkey % 700, 'customer' FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier)")
def union_of_sources(spark, d):
    from .registry import table

    o = table(spark, d, "orders").select((F.col("o_orderkey") % 500).alias("id"), F.lit("order").alias("kind"))
    c = table(spark, d, "customer").select((F.col("c_custkey") % 700).alias("id"), F.lit("customer").alias("kind"))
    return o.unionByName(c).unionByName(table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"))).distinct()
