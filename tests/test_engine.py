"""Sources, sinks, operators and streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltplane.functions import impedance, text
from voltplane.operators import aggregate, gates, joins, signal, windows
from voltplane.plans import publish
from voltplane.sources import recordings, texts


def test_binary_recording_round_trip(spark, tmp_path):
    samples = np.arange(3000, dtype="<f4").reshape(1000, 3)
    recordings.write_recording(str(tmp_path / "a_Karte_1.DAT"), ["1", "UC2", "Temp_1"], samples, 1000.0, "2024-01-01")
    (tmp_path / "b.DAT").write_bytes((tmp_path / "a_Karte_1.DAT").read_bytes()[:-7])
    recordings.register(spark)
    df = spark.read.format("recording").option("chunk", 128).option("chunksPerTask", 2).option("channels", "1,UC2").load(str(tmp_path / "*.DAT"))
    rows = df.where(F.col("path").contains("Karte")).collect()
    assert {(r.channel, r.role) for r in rows} == {("1", "segment"), ("UC2", "cell_voltage")} and rows[0].fs == pytest.approx(1000)
    got = np.concatenate([r.samples for r in sorted((r for r in rows if r.channel == "UC2"), key=lambda r: r.first_sample)])
    assert (got == samples[:, 1]).all()
    cut = df.where(F.col("path").endswith("b.DAT") & (F.col("channel") == "1")).agg(F.sum(F.size("samples"))).first()[0]
    assert cut == 999
    (tmp_path / "c.DAT").write_bytes(b"|CD,0.1;|CR,2;|CN,a;|CS,8;12345678")
    with pytest.raises(ValueError):
        recordings.read_header(str(tmp_path / "c.DAT"))


def test_text_dialects(spark, tmp_path):
    def put(name, body):
        (tmp_path / name).write_text(body)
        return str(tmp_path / name)

    rec = put("r.txt", "s1: t=0,1s; u_s=0.5V; uc=0.7V\ns2: t=0.1s; u_s=0.6V; uc=0.7V\ns1: t=0.2s; u_s=1e-1V; uc=0.7V\n")
    assert texts.dialect(spark, rec) == "records"
    assert sorted((r.instant, r.segment, r.t, r.u_s) for r in texts.records(spark, rec).collect()) == [(0, 1, 0.1, 0.5), (0, 2, 0.1, 0.6), (1, 1, 0.2, 0.1)]
    long = put("l.csv", "time,segment,value\n1,1,5\n0,1,4\n0,2,7\n")
    assert texts.dialect(spark, long) == "long" and sorted((r.segment, r.value) for r in texts.long_time(spark, long).collect()) == [(1, 4.0), (2, 7.0)]
    wide = put("w.csv", "time_s,s1,s2\n0,1,2\n1,3,x\n")
    assert texts.dialect(spark, wide) == "wide" and sorted((r.t, r.channel, r.value) for r in texts.wide_time(spark, wide).collect() if r.value is not None) == [(0.0, "s1", 1.0), (0.0, "s2", 2.0), (1.0, "s1", 3.0)]
    spec = put("f.csv", "segment,freq,z_mod,phase\n1,10,50,0\n1,100,40,-90\n")
    assert texts.dialect(spark, spec) == "frequency"
    z = sorted((r.freq_hz, r.z_re, r.z_im) for r in texts.spectra(spark, spec).collect())
    assert z[0] == pytest.approx((10, 0.05, 0)) and z[1] == pytest.approx((100, 0, -0.04))
    dta = put("x.DTA", "EXPLAIN\nTAG\tEISGALV\nZCURVE\tTABLE\n\tPt\tTime\tFreq\tZreal\tZimag\n\t#\ts\tHz\tohm\tohm\n\t0\t1\t1000\t0.5\t-0.1\n\t1\t2\t100\t0.6\t-0.2\n")
    assert texts.dialect(spark, dta) == "dta" and [(r.point, r.freq_hz, r.z_im) for r in texts.potentiostat(spark, dta).orderBy("point").collect()] == [(0, 1000.0, -0.1), (1, 100.0, -0.2)]
    step = put("s.csv", "s1:\ttemp1=0.1V;\ti_s=1A;u_s=2V;i_s=2A;u_s=4,5V;\n")
    assert texts.dialect(spark, step) == "calibration" and [(r.segment, r.pair, r.i, r.u) for r in texts.calibration_steps(spark, step).orderBy("pair").collect()] == [(1, 0, 1.0, 2.0), (1, 1, 2.0, 4.5)]
    (tmp_path / "z").mkdir()
    lines = put("z/z7.csv", "f= 10 Hz z= 0.5-0.25i\n")
    assert [tuple(r) for r in texts.spectrum_lines(spark, lines).collect()] == [(7, 10.0, 0.5, -0.25)]
    pairs = put("c.csv", "1;2\n3;4\n")
    assert [tuple(r) for r in texts.coefficient_pairs(spark, pairs).orderBy("number").collect()] == [(1, 1.0, 2.0), (2, 3.0, 4.0)]
    assert {r.key: r.value for r in texts.key_values(spark, put("m.txt", "Name: a: b\nnone\n")).collect()} == {"Name": "a: b"}
    assert [tuple(r) for r in texts.ragged(spark, put("g.csv", "a,b\n1,x, y\n"), ["a", "b"]).collect()] == [("1", "x, y")]
    with pytest.raises(ValueError):
        texts.dialect(spark, put("n.txt", "nothing\n"))


def test_publish(spark, tmp_path):
    store = publish.Store(spark, str(tmp_path / "tables"))
    key = {"order_id": "o1", "run_key": "o1/a"}
    one = spark.createDataFrame([(1, 5)], "Segment int, `Z re` int")
    assert store.read("silver") is None
    assert store.publish(key, {"silver": one}, spark.createDataFrame([("2024",)], "published string")) == ["silver", "runs"]
    store.publish({"order_id": "o1", "run_key": "o1/b"}, {"silver": spark.createDataFrame([(2, 0.5)], "segment int, z_re double")}, spark.createDataFrame([("2025",)], "published string"))
    store.publish(key, {"silver": spark.createDataFrame([(3, 7), (4, 8)], "segment int, z_re int")}, spark.createDataFrame([("2026",)], "published string"))
    assert sorted((r.run_key, r.segment, r.z_re) for r in store.read("silver").collect()) == [("o1/a", 3, 7.0), ("o1/a", 4, 8.0), ("o1/b", 2, 0.5)]
    assert [r.run_key for r in store.runs().collect()] == ["o1/a", "o1/b"]
    assert store.delete_run("o1/a", ["silver", "runs"])[0] == "runs"
    assert [r.run_key for r in store.read("silver").collect()] == ["o1/b"]
    found = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "run string, digest string")
    assert {r.run: r.action for r in publish.plan(found, found.where("run <> 'c'").withColumn("digest", F.lit("1")), "run").collect()} == {"a": "skip", "b": "changed", "c": "new"}


def test_equal_segments_in_parallel_give_themselves(spark):
    points = spark.createDataFrame([(f, s, 2.0 + s, 0.3, -0.1) for f in (1.0, 2.0) for s in range(4)], "f double, segment int, area double, re double, im double")
    for r in aggregate.parallel_sum(points, ["f"], "area", "re", "im", 28.0).collect():
        assert (r.z_used_re, r.z_used_im) == pytest.approx((0.3, -0.1)) and r.coverage == pytest.approx(0.5) and r.n_segments == 4


def test_h2_over_h1_is_the_inverse_coherence(spark):
    rng = np.random.default_rng(1)
    rows = [(1, *map(float, rng.normal(size=4))) for _ in range(50)]
    r = signal.cross_spectra(spark.createDataFrame(rows, "g int, a double, b double, c double, d double"), ["g"], "a", "b", "c", "d").first()
    assert np.hypot(r.h2_re, r.h2_im) / np.hypot(r.h1_re, r.h1_im) == pytest.approx(1 / r.coherence, rel=1e-9)


def test_gates_keep_the_first_reason(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, None, 1.0), (3, 50.0, None), (4, 5.0, 0.0)], "i int, f double, snr double")
    out = gates.staged(gates.ledger(df, [("band", gates.band("f", 1, 10)), ("snr", F.col("snr") > 0.5)]), ("late", F.col("i") > 1))
    assert {r.i: r.reason for r in out.collect()} == {1: "late", 2: "band", 3: "band", 4: "snr"}


def test_asof_and_interpolation(spark):
    right = spark.createDataFrame([("a", 1.0, 10.0), ("a", 4.0, 40.0)], "k string, f double, v double")
    left = spark.createDataFrame([("a", 0.5), ("a", 1.0), ("a", 2.0), ("a", 9.0), ("b", 1.0)], "k string, f double")
    assert sorted(((r.k, r.f, r.v) for r in joins.asof(left, right, ["k"], "f", ["v"]).collect()), key=repr) == [("a", 0.5, None), ("a", 1.0, 10.0), ("a", 2.0, 10.0), ("a", 9.0, 40.0), ("b", 1.0, None)]
    got = {(r.k, r.f): r.v for r in joins.interpolate_log(right, left, ["k"], "f", ["v"]).collect()}
    assert got[("a", 2.0)] == pytest.approx(25) and got[("a", 0.5)] == 10 and got[("a", 9.0)] == 40 and got[("b", 1.0)] is None


def test_unwrap_and_sessions(spark):
    rows = [(i, float((i * 2.5 + np.pi) % (2 * np.pi) - np.pi)) for i in range(20)]
    out = windows.unwrap(spark.createDataFrame(rows, "i int, p double").withColumn("g", F.lit(1)), ["g"], ["i"], "p").orderBy("i").collect()
    assert np.allclose(np.diff([r.unwrapped for r in out]), 2.5)
    s = windows.sessions(spark.createDataFrame([(1, 0.0), (1, 1.0), (1, 5.0)], "g int, t double"), ["g"], "t", 2.0).collect()
    assert sorted((r.start, r.stop, r.n) for r in s) == [(0.0, 1.0, 2), (5.0, 5.0, 1)]


def test_complex_functions(spark):
    w, tau = 30.0, 0.02
    root = np.sqrt(1j * w * tau)
    want = {"warburg": 0.3 * np.tanh(root) / root, "zarc": 0.5 / (1 + (1j * w * tau) ** 0.8), "late": (0.2 - 0.1j) * np.exp(2j * np.pi * 5 * 1e-3)}
    lit = F.lit
    got = spark.range(1).select(
        *[
            F.struct(*z).alias(n)
            for n, z in (("warburg", impedance.warburg(lit(w), lit(0.3), lit(tau))), ("zarc", impedance.zarc(lit(w), lit(0.5), lit(tau), lit(0.8))), ("late", impedance.delayed((lit(0.2), lit(-0.1)), lit(5.0), lit(1e-3))))
        ],
        impedance.along(lit(2.5), [0.0, 2.0, 4.0], [lit(1.0), lit(2.0), lit(6.0)]).alias("t"),
    ).first()
    for n, z in want.items():
        assert complex(*got[n]) == pytest.approx(z)
    assert got.t == pytest.approx(3.0)


def test_names(spark):
    df = spark.createDataFrame([("x/o1/gen2/450A/test_03/full",), ("nothing",)], "p string").select(*text.run_key(F.col("p")), text.nominal_label(F.lit(448.0)).alias("n"))
    assert tuple(df.first()) == ("o1", "gen2", "450A", "03", "full", "450A") and text.safe_column(" Z re (ohm)") == "z_re_ohm"


def test_streams(spark, tmp_path):
    from voltplane.streaming import samples as streams

    rows = spark.range(300).select((F.timestamp_seconds(1_700_000_000 + F.col("id") * 2 + (F.col("id") / 100).cast("int") * 600)).alias("t"), F.lit("c1").alias("card"), (F.col("id") % 3).alias("segment"), F.col("id").cast("double").alias("value"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))

    def run(df, mode="complete"):
        q = df.writeStream.format("memory").queryName("out_" + str(abs(hash(str(df.columns))) % 10**6)).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(q.name).collect()

    assert sorted(r.n for r in run(streams.dwells(stream, "1 minute"))) == [100, 100, 100]
    assert sum(r.n for r in run(streams.frames(stream, "5 minutes"))) == 300
    got = run(streams.drift(stream.select("t", "card", "value")), "update")
    t = np.array([1_700_000_000 + i * 2 + i // 100 * 600 for i in range(300)], float)
    assert got[-1].n == 300 and got[-1].slope_ppm == pytest.approx(np.polyfit(t - t[0], np.arange(300), 1)[0] * 1e6, rel=1e-6)


def test_a_table_is_not_lost_between_the_renames_of_a_rewrite(spark, tmp_path):
    from voltplane.plans import publish

    store = publish.Store(spark, f"file://{tmp_path}")
    key = dict.fromkeys(publish.PARTITIONS, "k")
    store.upsert("t", publish.tidy(spark.createDataFrame([(1,)], "v int"), key))
    assert store._rename("t", "_t_old") and store.read("t").count() == 1
    # a wider type rewrites the table
    store.upsert("t", publish.tidy(spark.createDataFrame([(2.5,)], "v double"), dict.fromkeys(publish.PARTITIONS, "m")))
    assert sorted(r.v for r in store.read("t").collect()) == [1.0, 2.5]


def test_logger_points_gains_and_areas(spark, tmp_path):
    def put(name, body):
        (tmp_path / name).write_text(body, encoding="utf-8")
        return str(tmp_path / name)

    point = put("p.csv", "\ufefftimestamp\tseg_1\ttemp_1\tUC\ntimeshifts\t0\t10.5\t21\n2024.01.01 00:00:01,500000\t0.5\t65\t0.7\n2024.01.01 00:00:02,000000\t0.6\t66\tx\n")
    rows = {(r.t, r.channel): r for r in texts.point_files(spark, point).collect()}
    assert len(rows) == 6 and rows[(0.5, "seg_1")].value == 0.6 and rows[(0.5, "UC")].value is None and rows[(0.0, "UC")].shift_s == pytest.approx(21e-6)
    assert rows[(0.0, "temp_1")].unit == "degC" and rows[(0.0, "seg_1")].role == "segment" and rows[(0.0, "seg_1")].unit is None
    assert texts.point_files(spark, put("q.csv", "timestamp\ta\n2024.01.01 00:00:01\t1\n")).count() == 0
    gain = texts.gain_table(spark, put("g.csv", "# a note\nsegment,freq_hz,gain_real,gain_imag\nall;10;1;0\n7,20,0.9,-0.1\n7,x,1,1\n8,1\n"))
    assert sorted(map(tuple, gain.collect()), key=repr) == [(7, 20.0, 0.9, -0.1), (None, 10.0, 1.0, 0.0)]
    texts.write_gain_table(gain, str(tmp_path / "out"))
    assert sorted(map(tuple, texts.gain_table(spark, str(tmp_path / "out")).collect()), key=repr) == sorted(map(tuple, gain.collect()), key=repr)
    assert [tuple(r) for r in texts.area_table(spark, put("a.csv", "segment,area_cm2\n1,2.5\n2,0\n")).collect()] == [(1, 2.5)]
    sweeps = spark.createDataFrame([("a", 1, 10.0, 0.5, -0.1), ("a", 0, 100.0, 0.4, -0.2), ("b", 0, 1.0, 0.3, 0.0)], "sweep string, point int, freq_hz double, z_re double, z_im double")
    texts.write_potentiostat(sweeps, str(tmp_path / "dta"))
    back = texts.potentiostat(spark, str(tmp_path / "dta")).withColumn("sweep", F.regexp_extract("path", "sweep=([a-z])", 1))
    assert sorted(map(tuple, back.select(sweeps.columns).collect())) == sorted(map(tuple, sweeps.collect()))
    publish.write_json(sweeps.select("sweep", F.lit(None).cast("int").alias("none")).distinct(), str(tmp_path / "json"))
    assert sorted(map(str, (r.value for r in spark.read.text(str(tmp_path / "json")).collect()))) == ['{"sweep":"a","none":null}', '{"sweep":"b","none":null}']


def test_recordings_by_uri_in_many_spans(spark, tmp_path):
    samples = np.arange(30000, dtype="<f4").reshape(10000, 3)
    recordings.write_recording(str(tmp_path / "r.DAT"), ["1", "2", "UC"], samples, 1000.0)
    recordings.register(spark)
    df = spark.read.format("recording").option("chunk", 100).option("chunksPerTask", 7).load(f"file://{tmp_path}/*.DAT")
    assert df.rdd.getNumPartitions() > 10
    rows = df.where("channel = '2'").orderBy("first_sample").collect()
    assert [r.first_sample for r in rows] == list(range(0, 10000, 100)) and (np.concatenate([r.samples for r in rows]) == samples[:, 1]).all()


def test_exact_quantiles_and_carried_rows(spark):
    from voltplane.operators import robust

    rng = np.random.default_rng(5)
    rows = [("a", float(x)) for x in rng.normal(size=999)] + [("b", 7.0)] * 50 + [("c", float(x)) for x in rng.integers(0, 4, 200)] + [("c", None), ("d", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    shares = [0.0, 0.02, 0.5, 0.98, 1.0]
    got = {(r.k, r.share): r.quantile for r in robust.quantiles(df, ["k"], "v", shares, bins=16).collect()}
    for k in "abcd":
        mine = [v for key, v in rows if key == k and v is not None]
        for s in shares:
            assert got[(k, s)] == pytest.approx(np.quantile(mine, s), abs=1e-12)
    # one value far out doesn't push all others into one bin
    far = spark.range(0, 50_000, 1, 6).select(F.lit("x").alias("k"), F.when(F.col("id") == 7, 1e12).otherwise(F.rand(1)).alias("v"))
    sizes = [r["count"] for r in robust.rank_bins(far, ["k"], "v", 40).groupBy("_bin").count().collect()]
    assert sum(sizes) == 50_000 and max(sizes) < 5_000
    assert robust.quantiles(far, ["k"], "v", [1.0]).first().quantile == 1e12
    ordered = spark.createDataFrame([("a", i, bool(i % 7 not in (0, 3))) for i in range(60)], "k string, t int, on boolean")
    one = windows.runs_of_true(ordered, ["k"], ["t"], F.col("on"))
    many = windows.runs_of_true(ordered, ["k"], ["t"], F.col("on"), F.floor(F.col("t") / 4))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) and one.count() > 15
    prior = {r.t: r._before.t if r._before else None for r in windows.before(ordered, ["k"], ["t"], ["t"], F.floor(F.col("t") / 4)).collect()}
    assert prior == {i: i - 1 if i else None for i in range(60)}


def test_pairs_within_a_ratio(spark):
    rng = np.random.default_rng(6)
    x, y = np.exp(rng.uniform(-2, 2, 80)), np.exp(rng.uniform(-2, 2, 80))
    left = spark.createDataFrame([("k", float(v)) for v in [*x, 1.0, 1.0]], "k string, x double")
    right = spark.createDataFrame([("k", float(v)) for v in [*y, 0.97, 1.03]], "k string, y double")
    got = sorted((r.x, r.y) for r in joins.within_ratio(left, right, ["k"], "x", "y", 0.03).collect())
    assert got == sorted((float(a), float(b)) for a in [*x, 1.0, 1.0] for b in [*y, 0.97, 1.03] if abs(b / a - 1) <= 0.03)


def test_lines_are_numbered_over_splits(spark, tmp_path):
    from voltplane.sources import texts

    made = {"a.txt": [f"line {i} " + "x" * (i % 40) for i in range(5000)], "b.txt": ["", "one", "", "two", ""], "empty.txt": []}
    for name, rows in made.items():
        (tmp_path / name).write_bytes("".join(f"{r}\r\n" if name == "b.txt" else f"{r}\n" for r in rows).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        df = texts.lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = {}
        for r in df.collect():
            got.setdefault(r.path.rsplit("/", 1)[1], {})[r.line_no] = r.line
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {name: dict(enumerate(rows)) for name, rows in made.items() if rows}
