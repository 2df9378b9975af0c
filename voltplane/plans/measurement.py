"""From recordings to spectra: multisine frames and stepped sines, on chunks of channels (path, channel, role, fs, first_sample, samples).

Multisine: the excitation repeats after `period` samples, so a chunk of whole periods is a frame whose tones are orthogonal: phasors are sums in
column expressions, and cross spectra are averages over frames. Read recordings with `chunk` = samples of a frame.

Stepped sine: dwells are found on the reference channel of each card, then every channel of the card is fitted at each dwell's frequency, as sums over
chunks: no task holds a channel.
"""

from __future__ import annotations

from collections.abc import Iterator

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregate, numeric, scans, signal, sines


def tone_phasors(chunks: DataFrame, tones: list[float], frame: int) -> DataFrame:
    """(path, channel, role, frame, tone, re, im) of full frames; a tone must fit the frame a whole number of times."""
    rate = F.col("fs")
    whole = chunks.where(F.size("samples") == frame).withColumn("samples", signal.as_double(F.col("samples"))).withColumn("_m", signal.mean(F.col("samples")))
    centred = whole.withColumn("samples", F.transform("samples", lambda x: x - F.col("_m")))
    tone = F.explode(F.array(*[F.lit(float(f)) for f in tones]))
    rows = centred.select("path", "channel", "role", (F.col("first_sample") / frame).cast("long").alias("frame"), rate.alias("fs"), "samples", tone.alias("tone"))
    turn = lambda i: 2 * math.pi * F.col("tone") / F.col("fs") * i
    total = lambda f: F.aggregate(F.transform("samples", lambda x, i: x * f(turn(i))), F.lit(0.0), lambda s, x: s + x)
    return rows.select("path", "channel", "role", "frame", "tone", (2 * total(F.cos) / frame).alias("re"), (-2 * total(F.sin) / frame).alias("im"))


def multisine_impedance(phasors: DataFrame, calibration: DataFrame, reference: str) -> DataFrame:
    """(path, segment, freq_hz, z_re, z_im, coherence, sigma_rel, n_frames): cell voltage over current density, ohm cm2.

    calibration: (segment, h), the shunt's volts for an A/cm2 at the segment's temperature; a segment without one has no rows.
    """
    volts = phasors.where(F.col("channel") == reference).select("path", "frame", "tone", F.col("re").alias("u_re"), F.col("im").alias("u_im"))
    current = phasors.where(F.col("role") == "segment").withColumn("segment", F.col("channel").cast("int")).join(F.broadcast(calibration), "segment")
    current = current.where(F.col("h") != 0).select("path", "segment", "frame", "tone", (F.col("re") / F.col("h")).alias("i_re"), (F.col("im") / F.col("h")).alias("i_im"))
    s = signal.cross_spectra(current.join(volts, ["path", "frame", "tone"]), ["path", "segment", "tone"], "i_re", "i_im", "u_re", "u_im")
    return s.select("path", "segment", F.col("tone").alias("freq_hz"), F.col("h1_re").alias("z_re"), F.col("h1_im").alias("z_im"), "coherence", signal.relative_sigma(F.col("coherence"), F.col("n_frames")).alias("sigma_rel"), "n_frames")


def consistency(spectra: DataFrame, keys: list[str], least: int = 6) -> DataFrame:
    """(keys, n_points, n_elements, mu, residual_pct): the Kramers-Kronig test of each spectrum; nulls below `least` points."""

    def test(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("freq_hz")
        found = numeric.kramers_kronig(pdf.freq_hz.to_numpy(float), (pdf.z_re + 1j * pdf.z_im).to_numpy()) if len(pdf) >= least else (None, None, None)
        return pd.DataFrame([[*key, len(pdf), *found[:3]]], columns=[*keys, "n_points", "n_elements", "mu", "residual_pct"])

    types = dict(spectra.dtypes)
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "n_points long", "n_elements double", "mu double", "residual_pct double"])
    return spectra.groupBy(*keys).applyInPandas(test, schema)


def plate_spectrum(spectra: DataFrame, areas: DataFrame, cell_area: float, coherence: float = 0.9) -> DataFrame:
    """The whole cell's spectrum from the points that pass the coherence gate; areas: (segment, area)."""
    return aggregate.parallel_sum(spectra.where(F.col("coherence") >= coherence).join(F.broadcast(areas), "segment"), ["freq_hz"], "area", "z_re", "z_im", cell_area)


def schedule(chunks: DataFrame, reference: str, frame: int = 1024) -> DataFrame:
    """(path, step, freq_hz, start, stop, snr_db): the dwells of each recording, found on its reference channel.

    Frames come from blocks with halos, dwells from windows over one row a frame, and exact frequencies from phases of parts of a frame, so chunks may have any size.
    """
    known = chunks.where(F.col("channel") == reference)
    rate = known.groupBy("path").agg(F.first("fs").cast("double").alias("_fs"))
    runs = scans.top_runs(scans.frame_tops(known, frame), frame).join(F.broadcast(rate), "path")
    tones = runs.select("path", F.col("step").alias("tone"), (F.col("bin") * F.col("_fs") / frame).alias("freq_hz"), F.col("start").alias("first_sample"), (F.col("stop") - 1).alias("last_sample"))
    # a quarter of a frame first, as a bin is wide against what a whole frame can tell
    coarse = sines.exact_frequency(known, tones, max(8, frame // 4)).select("path", "tone", F.col("freq_hz").alias("_f"))
    better = tones.join(coarse, ["path", "tone"]).withColumn("freq_hz", F.col("_f")).drop("_f")
    exact = sines.exact_frequency(known, better, frame).select("path", F.col("tone").alias("step"), "freq_hz")
    return runs.join(exact, ["path", "step"]).select("path", "step", "freq_hz", "start", "stop", "snr_db")


def step_phasors(chunks: DataFrame, steps: DataFrame) -> DataFrame:
    """(path, channel, step, freq_hz, re, im, rms, n_samples): every channel fitted at every dwell of its recording, from sums over the chunks that the dwell overlaps."""
    tones = steps.select("path", F.col("step").alias("tone"), "freq_hz", F.col("start").alias("first_sample"), (F.col("stop") - 1).alias("last_sample"))
    fits = sines.solved(sines.sums_of_chunks(chunks, tones)).where((F.col("n") >= 8) & F.col("re").isNotNull())
    return fits.select("path", "channel", F.col("tone").alias("step"), "freq_hz", "re", "im", "rms", F.col("n").alias("n_samples"))


def step_impedance(phasors: DataFrame, calibration: DataFrame, reference: str) -> DataFrame:
    """(path, segment, freq_hz, z_re, z_im, snr_db) from stepped-sine phasors."""
    volts = phasors.where(F.col("channel") == reference).select("path", "step", F.col("re").alias("u_re"), F.col("im").alias("u_im"), F.col("rms").alias("u_rms"))
    current = phasors.where(F.col("channel").rlike(r"^\d+$")).withColumn("segment", F.col("channel").cast("int")).join(F.broadcast(calibration), "segment")
    both = current.join(volts, ["path", "step"])
    size = F.col("re") * F.col("re") + F.col("im") * F.col("im")
    z_re = (F.col("u_re") * F.col("re") + F.col("u_im") * F.col("im")) / size * F.col("h")
    z_im = (F.col("u_im") * F.col("re") - F.col("u_re") * F.col("im")) / size * F.col("h")
    snr = signal.combined_snr(signal.snr_db(F.col("re"), F.col("im"), F.col("rms")), signal.snr_db(F.col("u_re"), F.col("u_im"), F.col("u_rms")))
    return both.where(size > 0).select("path", "segment", "freq_hz", z_re.alias("z_re"), z_im.alias("z_im"), snr.alias("snr_db"))


def card_delays(chunks: DataFrame, anchor: str, band: tuple[float, float] = (20.0, 4000.0)) -> DataFrame:
    """(path, delay_s, error_s, n_chunks) of each recording's cell voltage against the anchor recording's: the cards' clocks.

    Chunks of the same samples meet, so no task holds more than two of them; the delay is the median over a recording's chunks. Delays are short
    against a chunk.
    """
    voltage = chunks.where(F.col("role") == "cell_voltage").select("path", "first_sample", "fs", "samples")
    ref = voltage.where(F.col("path") == anchor).select("first_sample", F.col("samples").alias("ref"))
    pairs = voltage.where(F.col("path") != anchor).join(ref, "first_sample").select("path", "fs", "ref", "samples")

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for row in pdf.itertuples():
                n = min(len(row.ref), len(row.samples))
                if n >= 64:
                    rows.append((row.path, *numeric.estimate_delay(np.asarray(row.ref[:n], float), np.asarray(row.samples[:n], float), float(row.fs), band)))
            yield pd.DataFrame(rows, columns=["path", "delay_s", "error_s"]).astype({"delay_s": float, "error_s": float})

    each = pairs.mapInPandas(measure, "path string, delay_s double, error_s double")
    return each.groupBy("path").agg(F.median("delay_s").alias("delay_s"), (F.median("error_s") / F.sqrt(F.count(F.lit(1)))).alias("error_s"), F.count(F.lit(1)).alias("n_chunks"))


def repeated_channels(chunks: DataFrame) -> DataFrame:
    """Groups of channels of a recording that hold the same bits, and channels that never change: (path, channels, kind)."""
    digest = chunks.select("path", "channel", "first_sample", F.xxhash64("samples").alias("h"), F.array_max("samples").alias("top"), F.array_min("samples").alias("low"))
    whole = digest.groupBy("path", "channel").agg(F.sort_array(F.collect_list(F.struct("first_sample", "h"))).alias("bits"), F.max("top").alias("top"), F.min("low").alias("low"))
    same = whole.groupBy("path", F.xxhash64("bits").alias("bits")).agg(F.sort_array(F.collect_list("channel")).alias("channels")).where(F.size("channels") > 1).select("path", "channels", F.lit("repeated").alias("kind"))
    flat = whole.where(F.col("top") == F.col("low")).select("path", F.array("channel").alias("channels"), F.lit("constant").alias("kind"))
    return same.unionByName(flat)
