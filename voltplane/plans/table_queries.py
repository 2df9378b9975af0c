"""Operators over windows of samples (embeddings), the plate's geometry (part), metadata and text."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregate, joins, robust, signal, windows
from .registry import query, rounded, table

PADS_SQL = "pads AS (SELECT p_partkey % 45 AS c, p_partkey // 45 % 20 AS r, p_size, p_retailprice, (p_partkey % 45) // 5 * 4 + (p_partkey // 45 % 20) // 5 AS segment FROM part)"
ADJACENT_SQL = "tile AS (SELECT DISTINCT c, r, segment FROM pads), adj AS (SELECT DISTINCT a.segment, b.segment AS neighbour FROM tile a JOIN tile b ON a.segment <> b.segment AND ((a.c = b.c AND abs(a.r - b.r) = 1) OR (a.r = b.r AND abs(a.c - b.c) = 1)))"
DOUBLES_SQL = "x AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS w FROM embeddings)"


def pads(spark, d):
    """Parts as measurements on the pads of a plate of 45 by 20, in 36 segments of 5 by 5."""
    p = table(spark, d, "part")
    col, row = F.col("p_partkey") % 45, F.floor(F.col("p_partkey") / 45) % 20
    return p.select(col.alias("col"), row.alias("row"), "p_size", "p_retailprice", (F.floor(col / 5) * 4 + F.floor(row / 5)).alias("segment"))


def windows_of(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", signal.as_double(F.col("embedding")).alias("w"))


def sums_sql(k: int) -> tuple[str, str]:
    turn = f"2 * pi() * {k} * (i - 1) / len(w)"
    return f"list_sum(list_transform(w, lambda v, i: v * cos({turn})))", f"list_sum(list_transform(w, lambda v, i: v * sin({turn})))"


C3, S3 = sums_sql(3)
C6, S6 = sums_sql(6)
C9, S9 = sums_sql(9)


@query(
    "sine_fit3_dft",
    f"""WITH {DOUBLES_SQL}, f AS (SELECT vec_id, 2 * {C3} / len(w) AS re, -2 * {S3} / len(w) AS im, sqrt(greatest(0, list_sum(list_transform(w, lambda v: v * v)) / len(w) - pow(list_sum(w) / len(w), 2) - (pow(2 * {C3} / len(w), 2) + pow(2 * {S3} / len(w), 2)) / 2)) AS rms FROM x)
    SELECT vec_id, round(re, 6) AS re, round(im, 6) AS im, round(rms, 6) AS rms, round(20 * log10(sqrt((re * re + im * im) / 2) / rms), 5) AS snr_db FROM f""",
)
def sine_fit3_dft(spark, d):
    re, im = signal.phasor(F.col("w"), 3)
    f = windows_of(spark, d).withColumn("re", re).withColumn("im", im).withColumn("rms", signal.residual_rms(F.col("w"), F.col("re"), F.col("im")))
    return f.select("vec_id", F.round("re", 6).alias("re"), F.round("im", 6).alias("im"), F.round("rms", 6).alias("rms"), F.round(signal.snr_db(F.col("re"), F.col("im"), F.col("rms")), 5).alias("snr_db"))


@query("harmonic_distortion", f"WITH {DOUBLES_SQL} SELECT vec_id, round(sqrt(pow({C6}, 2) + pow({S6}, 2) + pow({C9}, 2) + pow({S9}, 2)) / sqrt(pow({C3}, 2) + pow({S3}, 2)), 6) AS thd FROM x")
def harmonic_distortion(spark, d):
    return windows_of(spark, d).select("vec_id", F.round(signal.harmonic_distortion(F.col("w"), 3), 6).alias("thd"))


@query(
    "h1_h2_hv_coherence",
    f"""WITH {DOUBLES_SQL}, f AS (SELECT vec_id, label, {C3} AS a, -({S3}) AS b FROM x), q AS (SELECT u.label, u.a, u.b, v.a AS c, v.b AS d FROM f u JOIN f v ON v.vec_id = u.vec_id + 1),
    s AS (SELECT label, avg(a * a + b * b) AS sxx, avg(c * c + d * d) AS syy, avg(a * c + b * d) AS xr, avg(a * d - b * c) AS xi, count(*) AS n FROM q GROUP BY label)
    SELECT label, n AS n_frames, round(xr / sxx, 6) AS h1_re, round(xi / sxx, 6) AS h1_im, round(syy * xr / (xr * xr + xi * xi), 4) AS h2_re, round(syy * xi / (xr * xr + xi * xi), 4) AS h2_im,
    round(sqrt(syy / sxx) * xr / sqrt(xr * xr + xi * xi), 6) AS hv_re, round(sqrt(syy / sxx) * xi / sqrt(xr * xr + xi * xi), 6) AS hv_im, round((xr * xr + xi * xi) / (sxx * syy), 6) AS coherence FROM s""",
)
def h1_h2_hv_coherence(spark, d):
    c, s = signal.dft(F.col("w"), 3)
    f = windows_of(spark, d).select("vec_id", "label", c.alias("re"), (-s).alias("im"))
    pairs = f.select((F.col("vec_id") + 1).alias("vec_id"), "label", F.col("re").alias("a"), F.col("im").alias("b")).join(f.select("vec_id", F.col("re").alias("c"), F.col("im").alias("d")), "vec_id")
    out = signal.cross_spectra(pairs, ["label"], "a", "b", "c", "d")
    return out.select("label", "n_frames", *[F.round(x, 4 if x.startswith("h2") else 6).alias(x) for x in ("h1_re", "h1_im", "h2_re", "h2_im", "hv_re", "hv_im", "coherence")])


@query(
    "window_level_gate",
    f"""WITH {DOUBLES_SQL}, l AS (SELECT vec_id, label, round(sqrt(list_sum(list_transform(w, lambda v: v * v)) / len(w)) * (1 + vec_id % 3), 12) AS level FROM x), m AS (SELECT label, median(level) AS m FROM l GROUP BY label),
    s AS (SELECT label, median(abs(level - m)) AS s FROM l JOIN m USING (label) GROUP BY label), k AS (SELECT l.*, abs(level - m) <= 1.1 * 1.4826 * s AS ok FROM l JOIN m USING (label) JOIN s USING (label)),
    o AS (SELECT label, avg(CASE WHEN ok THEN 0.0 ELSE 1.0 END) AS o FROM k GROUP BY label) SELECT vec_id, round(level, 6) AS level, (ok OR o > 0.5) AS accepted FROM k JOIN o USING (label)""",
)
def window_level_gate(spark, d):
    power = F.aggregate(F.transform("w", lambda v: v * v), F.lit(0.0), lambda a, v: a + v) / F.size("w")
    levels = windows_of(spark, d).select("vec_id", "label", F.round(F.sqrt(power) * (1 + F.col("vec_id") % 3), 12).alias("level"))
    return signal.level_gate(levels, ["label"], "level", k=1.1).select("vec_id", F.round("level", 6).alias("level"), "accepted")


@query(
    "phase_unwrap",
    f"""WITH {DOUBLES_SQL}, f AS (SELECT vec_id, label, atan2(-({S3}), {C3}) AS phase FROM x), t AS (SELECT *, coalesce(-round((phase - lag(phase) OVER (PARTITION BY label ORDER BY vec_id)) / (2 * pi())), 0) AS turn FROM f)
    SELECT vec_id, round(phase + 2 * pi() * sum(turn) OVER (PARTITION BY label ORDER BY vec_id), 6) AS unwrapped FROM t""",
)
def phase_unwrap(spark, d):
    c, s = signal.dft(F.col("w"), 3)
    f = windows_of(spark, d).select("vec_id", "label", F.atan2(-s, c).alias("phase"))
    return windows.unwrap(f, ["label"], ["vec_id"], "phase").select("vec_id", F.round("unwrapped", 6).alias("unwrapped"))


@query(
    "tone_clusters",
    """WITH o AS (SELECT o_orderpriority AS card, o_orderkey % 1000 AS k, max(o_totalprice) / 5e5 AS coherence FROM orders GROUP BY ALL), f AS (SELECT card, CAST(k AS DOUBLE) AS f FROM o WHERE coherence >= 0.9),
    n AS (SELECT *, CASE WHEN f - lag(f) OVER (PARTITION BY card ORDER BY f) > 3 THEN 1 ELSE 0 END AS new FROM f), c AS (SELECT card, f, sum(new) OVER (PARTITION BY card ORDER BY f) AS cluster FROM n)
    SELECT card, CAST(cluster AS BIGINT) AS cluster, round(avg(f), 6) AS tone_hz, count(*) AS n FROM c GROUP BY ALL""",
)
def tone_clusters(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("card"), (F.col("o_orderkey") % 1000).cast("double").alias("f")).agg((F.max("o_totalprice") / 5e5).alias("coherence"))
    return rounded(windows.clusters(o.where("coherence >= 0.9"), ["card"], "f", 3).groupBy("card", "cluster").agg(F.avg("f").alias("tone_hz"), F.count(F.lit(1)).alias("n")))


@query(
    "spatial_trends_partial_corr",
    f"""WITH {PADS_SQL}, s AS (SELECT segment, avg(c) AS x, avg(r) AS y, count(*) + segment % 3 AS area, avg(p_size) AS v FROM pads GROUP BY segment), u AS (SELECT *, abs(x - 22) AS edge FROM s),
    a AS (SELECT regr_slope(v, edge) AS be, regr_intercept(v, edge) AS ae, regr_slope(v, area) AS ba, regr_intercept(v, area) AS aa FROM u)
    SELECT count(*) AS n, round(corr(x, v), 6) AS r_along, round(corr(y, v), 6) AS r_across, round(corr(edge, v), 6) AS r_edge, round(corr(area, v), 6) AS r_area, round(corr(area, v - be * edge - ae), 6) AS r_area_partial, round(corr(edge, v - ba * area - aa), 6) AS r_edge_partial FROM u, a""",
)
def spatial_trends_partial_corr(spark, d):
    s = pads(spark, d).groupBy("segment").agg(F.avg("col").alias("x"), F.avg("row").alias("y"), F.count(F.lit(1)).alias("n"), F.avg("p_size").alias("v"))
    s = s.withColumn("area", F.col("n") + F.col("segment") % 3).withColumn("edge", F.abs(F.col("x") - 22))
    plain = s.agg(F.count(F.lit(1)).alias("n"), *[F.round(F.corr(c, "v"), 6).alias(f"r_{name}") for c, name in (("x", "along"), ("y", "across"), ("edge", "edge"), ("area", "area"))])
    partial = [aggregate.partial_corr(s, "v", of, control).select(F.round("r", 6).alias(f"r_{of}_partial")) for of, control in (("area", "edge"), ("edge", "area"))]
    # one row each
    return plain.join(F.broadcast(partial[0])).join(F.broadcast(partial[1]))


@query(
    "adjacency_outliers",
    f"""WITH {PADS_SQL}, {ADJACENT_SQL}, v AS (SELECT segment, avg(p_size) AS v FROM pads GROUP BY segment), r AS (SELECT a.segment, b.v FROM adj a JOIN v b ON a.neighbour = b.segment),
    m AS (SELECT segment, median(v) AS med, (max(v) - min(v)) / 2 AS half, count(*) AS n FROM r GROUP BY segment), s AS (SELECT r.segment, median(abs(v - med)) AS mad FROM r JOIN m USING (segment) GROUP BY r.segment)
    SELECT segment, round((v - med) / CASE WHEN mad > 0 THEN mad / 0.6745 WHEN half > 0 THEN half END, 6) AS z, n AS n_ring FROM v JOIN m USING (segment) JOIN s USING (segment)""",
)
def adjacency_outliers(spark, d):
    p = pads(spark, d)
    value = p.groupBy("segment").agg(F.avg("p_size").alias("v"))
    ring = joins.adjacency(p).join(value.select(F.col("segment").alias("neighbour"), "v"), "neighbour")
    centre = ring.groupBy("segment").agg(F.median("v").alias("med"), ((F.max("v") - F.min("v")) / 2).alias("half"), F.count(F.lit(1)).alias("n_ring"))
    mad = ring.join(centre, "segment").groupBy("segment").agg(F.median(F.abs(F.col("v") - F.col("med"))).alias("mad"))
    sigma = F.when(F.col("mad") > 0, F.col("mad") / robust.SIGMA_MAD).when(F.col("half") > 0, F.col("half"))
    return value.join(centre, "segment").join(mad, "segment").select("segment", F.round((F.col("v") - F.col("med")) / sigma, 6).alias("z"), "n_ring")


@query(
    "donor_ring_two_hops",
    f"""WITH {PADS_SQL}, {ADJACENT_SQL}, s AS (SELECT DISTINCT segment FROM pads), have AS (SELECT segment FROM s WHERE segment % 3 = 0), want AS (SELECT segment FROM s WHERE segment % 3 <> 0),
    one AS (SELECT w.segment, a.neighbour AS spot, 1 AS hops FROM want w JOIN adj a USING (segment)), two AS (SELECT DISTINCT o.segment, a.neighbour AS spot, 2 AS hops FROM one o JOIN adj a ON o.spot = a.segment WHERE a.neighbour <> o.segment AND NOT EXISTS (SELECT 1 FROM one q WHERE q.segment = o.segment AND q.spot = a.neighbour)),
    k AS (SELECT * FROM one UNION ALL SELECT * FROM two), f AS (SELECT k.* FROM k JOIN have h ON k.spot = h.segment) SELECT segment, spot AS donor, hops FROM f WHERE hops = (SELECT min(g.hops) FROM f g WHERE g.segment = f.segment)""",
)
def donor_ring_two_hops(spark, d):
    p = pads(spark, d)
    segments = p.select("segment").distinct()
    return joins.donor_ring(segments.where("segment % 3 <> 0"), joins.adjacency(p), segments.where("segment % 3 = 0"))


@query("missing_segments_anti", "SELECT c_custkey AS segment, c_mktsegment AS plate FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')")
def missing_segments_anti(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select(F.col("c_custkey").alias("segment"), F.col("c_mktsegment").alias("plate"))


@query("order_discovery_distinct_join", "SELECT DISTINCT n_name AS plate, c_mktsegment AS kind FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
def order_discovery_distinct_join(spark, d):
    o = table(spark, d, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select(F.col("n_name").alias("plate"), F.col("c_mktsegment").alias("kind")).distinct()


KEY = r"([^/]+)/([^/]+)/([0-9]+A)/test_([0-9]+)(?:/([a-z_]+))?/?$"


@query(
    "run_key_parse",
    "WITH k AS (SELECT page_id, 'runs/' || regexp_extract(url, '://([^/]+)', 1) || '/gen' || (page_id % 2 + 1) || '/' || (page_id % 9 * 50) || 'A/test_0' || (page_id % 4) || CASE WHEN page_id % 3 = 0 THEN '/full_band' ELSE '' END AS path FROM pages) SELECT page_id, "
    + ", ".join(f"regexp_extract(path, '{KEY}', {i}) AS {c}" for i, c in enumerate(("order_id", "plate", "condition", "test_id", "eval_mode"), 1))
    + " FROM k",
)
def run_key_parse(spark, d):
    i = F.col("page_id")
    path = F.concat(F.lit("runs/"), F.regexp_extract("url", "://([^/]+)", 1), F.lit("/gen"), (i % 2 + 1).cast("string"), F.lit("/"), (i % 9 * 50).cast("string"), F.lit("A/test_0"), (i % 4).cast("string"), F.when(i % 3 == 0, "/full_band").otherwise(""))
    return table(spark, d, "pages").select("page_id", *text.run_key(path))


@query(
    "condition_numeric_sort",
    "WITH c AS (SELECT DISTINCT p_size || 'A' AS condition FROM part) SELECT condition, CAST(regexp_extract(condition, '[0-9]+') AS DOUBLE) AS current_a, row_number() OVER (ORDER BY CAST(regexp_extract(condition, '[0-9]+') AS DOUBLE), condition) AS rank FROM c",
)
def condition_numeric_sort(spark, d):
    c = table(spark, d, "part").select(F.concat(F.col("p_size").cast("string"), F.lit("A")).alias("condition")).distinct()
    # the few conditions of a campaign are ranked in one task
    rank = F.row_number().over(Window.orderBy(*text.condition_order(F.col("condition"))))
    return c.select("condition", text.number_in(F.col("condition")).alias("current_a"), rank.cast("long").alias("rank"))


@query(
    "records_text_parse",
    """WITH n AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n, length(text) AS len, regexp_extract(text, '([A-Za-z]+)', 1) AS word FROM conversations)
    SELECT conv_id, turn, role, CAST(max(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS instant, CAST(len AS BIGINT) AS n_chars, word FROM n""",
)
def records_text_parse(spark, d):
    c = table(spark, d, "conversations")
    out = text.instants(c, ["turn"], "role", ["conv_id"])
    return out.select("conv_id", "turn", "role", F.col("instant").cast("long").alias("instant"), F.length("text").cast("long").alias("n_chars"), F.regexp_extract("text", "([A-Za-z]+)", 1).alias("word"))


@query(
    "plan_new_changed",
    "SELECT d.doc_id AS run, CASE WHEN l.doc_id IS NULL THEN 'new' WHEN l.quality <> d.doc_id % 2 THEN 'changed' ELSE 'skip' END AS action, sha256(CAST(n_chars AS VARCHAR)) AS digest FROM documents d LEFT JOIN labels l USING (doc_id)",
)
def plan_new_changed(spark, d):
    from . import publish

    runs = table(spark, d, "documents").select(F.col("doc_id").alias("run"), (F.col("doc_id") % 2).cast("int").alias("digest"), F.sha2(F.col("n_chars").cast("string"), 256).alias("sha"))
    known = table(spark, d, "labels").select(F.col("doc_id").alias("run"), F.col("quality").alias("digest"))
    return publish.plan(runs, known, "run").select("run", "action", F.col("sha").alias("digest"))


@query("channel_roles", "SELECT CASE WHEN regexp_matches(trim(n), '^-?\\d+$') THEN 'segment' WHEN upper(trim(n)) LIKE 'UC%' THEN 'cell_voltage' WHEN lower(trim(n)) LIKE 'temp%' THEN 'temperature' ELSE 'other' END AS role, count(*) AS n FROM (SELECT CASE p_size % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN 'UC' || p_size WHEN 2 THEN 'Temp_' || p_size ELSE p_name END AS n FROM part) GROUP BY role")
def channel_roles(spark, d):
    s, kind = F.col("p_size").cast("string"), F.col("p_size") % 4
    name = F.when(kind == 0, s).when(kind == 1, F.concat(F.lit("UC"), s)).when(kind == 2, F.concat(F.lit("Temp_"), s)).otherwise(F.col("p_name"))
    return table(spark, d, "part").groupBy(text.channel_role(name).alias("role")).agg(F.count(F.lit(1)).alias("n"))


TAU = 2 * math.pi


@query(
    "circuit_elements",
    """WITH w AS (SELECT p_partkey, 2 * pi() * p_size AS w, 0.01 + (p_partkey % 7) / 100.0 AS r, 0.001 * (1 + p_partkey % 5) AS tau, 0.8 AS n FROM part),
    z AS (SELECT *, pow(w * tau, n) * cos(n * pi() / 2) AS a, pow(w * tau, n) * sin(n * pi() / 2) AS b FROM w)
    SELECT p_partkey, round(r * (1 + a) / ((1 + a) * (1 + a) + b * b), 9) AS zarc_re, round(-r * b / ((1 + a) * (1 + a) + b * b), 9) AS zarc_im, round(cos(w * 1e-4) * r, 9) AS late_re, round(sin(w * 1e-4) * r, 9) AS late_im FROM z""",
)
def circuit_elements(spark, d):
    from ..functions import impedance

    p = table(spark, d, "part")
    w, r, tau = TAU * F.col("p_size"), 0.01 + (F.col("p_partkey") % 7) / 100.0, 0.001 * (1 + F.col("p_partkey") % 5)
    z = impedance.zarc(w, r, tau, F.lit(0.8))
    late = impedance.delayed((r, F.lit(0.0)), F.col("p_size"), F.lit(1e-4))
    return p.select("p_partkey", *[F.round(x, 9).alias(c) for x, c in zip((*z, *late), ("zarc_re", "zarc_im", "late_re", "late_im"), strict=True)])
