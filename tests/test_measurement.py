"""Recordings with known impedance in, spectra out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltplane.plans import measurement
from voltplane.sources import recordings

FS, TONES = 1000.0, [2.0, 5.0, 17.0, 60.0, 210.0]


def impedance(f, segment):
    return 0.05 * (1 + 0.1 * segment) + 0.02 / (1 + 2j * np.pi * f * 0.01)


@pytest.fixture(scope="module")
def multisine(spark, tmp_path_factory):
    rng, folder, frame = np.random.default_rng(0), tmp_path_factory.mktemp("multi"), 1000
    t = np.arange(20 * frame) / FS
    phases = rng.uniform(0, 2 * np.pi, len(TONES))
    u = sum(1e-2 * np.cos(2 * np.pi * f * t + p) for f, p in zip(TONES, phases, strict=True))
    names, columns = ["UC1"], [u + 1e-5 * rng.normal(size=len(t))]
    for s in (1, 2, 3):
        i = sum(np.real(1e-2 / impedance(f, s) * np.exp(1j * (2 * np.pi * f * t + p))) for f, p in zip(TONES, phases, strict=True))
        names.append(str(s))
        columns.append(0.5 * i + 1e-5 * rng.normal(size=len(t)))
    recordings.write_recording(str(folder / "a.DAT"), names, np.stack(columns, axis=1), FS)
    recordings.register(spark)
    return spark.read.format("recording").option("chunk", frame).load(str(folder / "a.DAT"))


def test_multisine(spark, multisine):
    calibration = spark.createDataFrame([(s, 0.5) for s in (1, 2, 3)], "segment int, h double")
    z = measurement.multisine_impedance(measurement.tone_phasors(multisine, TONES, 1000), calibration, "UC1").cache()
    rows = z.collect()
    assert len(rows) == 15
    for r in rows:
        assert complex(r.z_re, r.z_im) == pytest.approx(impedance(r.freq_hz, r.segment), rel=3e-3) and r.coherence > 0.99
    kk = measurement.consistency(z, ["segment"], least=5).collect()
    assert len(kk) == 3 and all(r.residual_pct < 5 for r in kk)
    areas = spark.createDataFrame([(s, 2.0) for s in (1, 2, 3)], "segment int, area double")
    for r in measurement.plate_spectrum(z, areas, 6.0).collect():
        want = 6.0 / sum(2.0 / impedance(r.freq_hz, s) for s in (1, 2, 3))
        assert complex(r.z_full_re, r.z_full_im) == pytest.approx(want, rel=3e-3) and r.coverage == pytest.approx(1)


def test_stepped_sine(spark, tmp_path):
    rng = np.random.default_rng(1)
    u, i = [], []
    for f in (200.0, 90.0, 40.0, 21.0):
        t = np.arange(8000) / FS
        u.append(1e-2 * np.cos(2 * np.pi * f * t))
        i.append(np.real(1e-2 / impedance(f, 1) * np.exp(2j * np.pi * f * t)))
    u, i = np.concatenate(u), np.concatenate(i)
    samples = np.stack([u, i, i, np.zeros_like(u)], axis=1) + np.array([1, 0, 0, 0]) * 1e-6 * rng.normal(size=(len(u), 1))
    recordings.write_recording(str(tmp_path / "s.DAT"), ["UC1", "1", "2", "Temp_1"], samples, FS)
    recordings.register(spark)
    chunks = spark.read.format("recording").option("chunk", 4096).load(str(tmp_path / "s.DAT"))
    steps = measurement.schedule(chunks, "UC1", 512).cache()
    assert [round(r.freq_hz) for r in steps.orderBy("step").collect()] == [200, 90, 40, 21]
    z = measurement.step_impedance(measurement.step_phasors(chunks, steps), spark.createDataFrame([(1, 1.0)], "segment int, h double"), "UC1").collect()
    assert len(z) == 4
    for r in z:
        assert complex(r.z_re, r.z_im) == pytest.approx(impedance(r.freq_hz, 1), rel=5e-3)
    found = {(r.kind, tuple(r.channels)) for r in measurement.repeated_channels(chunks).collect()}
    assert found == {("repeated", ("1", "2")), ("constant", ("Temp_1",))}


def test_card_delays(spark, tmp_path):
    from voltplane.operators import numeric

    rng = np.random.default_rng(2)
    x = rng.normal(size=20000)
    x = np.fft.irfft(np.fft.rfft(x) * (np.fft.rfftfreq(len(x), 1e-4) < 4000), len(x))
    for n, d in (("a", 0.0), ("b", 3.3e-4)):
        recordings.write_recording(str(tmp_path / f"{n}.DAT"), ["UC1"], numeric.shifted(x, -d, 1e4)[:, None], 1e4)
    recordings.register(spark)
    chunks = spark.read.format("recording").load(str(tmp_path / "*.DAT"))
    row = measurement.card_delays(chunks, str(tmp_path / "a.DAT")).first()
    assert row.delay_s == pytest.approx(3.3e-4, abs=1e-6)
    assert chunks.select("role").distinct().where(F.col("role") == "cell_voltage").count() == 1
