"""Text measurements as DataFrames: record lines, wide and long tables, spectra, potentiostat files, calibration steps, key-value sidecars.

Lines are numbered within their file though files are read by splits, so the order of lines needs no whole file in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import instants

NUMBER = r"([-+]?[0-9]*[.,]?[0-9]+(?:[eE][-+]?[0-9]+)?)"


def number(text: Column) -> Column:
    return F.regexp_replace(F.nullif(F.trim(text), F.lit("")), ",", ".").try_cast("double")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, line) of text files; line numbers count from 0 within a file, which may be of any size.

    Files are read by splits. A task numbers its rows in a row, so a line's place in its split is its number less the split's least one, and the lines of the splits before it are added: one record a
    split. A line end at a file's end begins no further line.
    """
    at = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    rows = spark.read.text(path).select(at.alias("_at"), "value", F.monotonically_increasing_id().alias("_id")).select("_at.*", "value", "_id")
    splits = rows.groupBy("path", "start").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return rows.join(splits, ["path", "start"]).select("path", (F.col("_before") + F.col("_id") - F.col("_first")).cast("int").alias("line_no"), F.col("value").alias("line"))


def dialect(spark: SparkSession, path: str, n: int = 60) -> str:
    """records, spectra, dta, wide, long, frequency or calibration, from a file's first lines; the most particular first."""
    head = [r.line for r in lines(spark, path).where(F.col("line_no") < n).orderBy("line_no").limit(n).collect()]
    text = "\n".join(head)
    import re

    first = next((x for x in head if x.strip() and not x.startswith("#")), "").lower()
    for name, found in (
        ("dta", re.search(r"^ZCURVE\t", text, re.M)),
        ("calibration", re.search(r"^s\d+:.*i_s=", text, re.M)),
        ("records", re.search(r"^s\d+:\s*t=", text, re.M)),
        ("spectra", re.search(r"f=.*Hz.*z=", text)),
        ("frequency", re.search(r"freq", first) and re.search(r"z_?re|z_?mod|zreal", first)),
        ("long", re.search(r"\btime\b", first) and re.search(r"\bsegment\b", first)),
        ("wide", re.search(r"\btime", first)),
    ):
        if found:
            return name
    raise ValueError(f"{path}: no known layout")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(path, instant, segment, t, u_s, uc) from lines `s<n>: t=..s; u_s=..V; uc=..V`."""
    value = lambda k: number(F.regexp_extract("line", rf"\b{k}\s*=\s*{NUMBER}", 1))
    found = lines(spark, path).select("path", "line_no", F.regexp_extract("line", r"^s(\d+):", 1).alias("s"), value("t").alias("t"), value("u_s").alias("u_s"), value("uc").alias("uc")).where("s <> ''")
    found = found.withColumn("segment", F.col("s").cast("int")).drop("s")
    return instants(found, ["line_no"], "segment", ["path"]).select("path", "instant", "segment", "t", "u_s", "uc")


def table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return spark.read.option("header", True).option("sep", sep).option("comment", "#").csv(path)


def wide_time(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(t, channel, value) from a table with a row an instant: the first column whose name begins with time is t."""
    df = table(spark, path, sep)
    t = next(c for c in df.columns if c.strip().lower().startswith("time"))
    others = [c for c in df.columns if c != t]
    return df.select(number(F.col(t)).alias("t"), *[number(F.col(f"`{c}`")).alias(c) for c in others]).unpivot("t", others, "channel", "value")


def long_time(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(segment, n, t, value), each segment in time order and as long as the shortest."""
    df = table(spark, path, sep).select(F.col("segment").cast("int").alias("segment"), number(F.col("time")).alias("t"), number(F.col("value")).alias("value"))
    df = df.withColumn("n", F.row_number().over(Window.partitionBy("segment").orderBy("t")))
    shortest = df.groupBy("segment").agg(F.max("n").alias("m")).agg(F.min("m").alias("m"))
    return df.join(F.broadcast(shortest), F.col("n") <= F.col("m")).drop("m")


def spectra(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(segment, freq_hz, z_re, z_im) in ohm cm2, from real and imaginary part or from modulus and phase in degrees.

    The unit follows from the median over segments of the largest modulus: above 20 it is milliohm cm2, else ohm cm2.
    """
    df = table(spark, path, sep)
    names = {c.strip().lower(): c for c in df.columns}
    pick = lambda *keys: next((number(F.col(f"`{names[k]}`")) for k in keys if k in names), None)
    f, re, im, mod, deg = pick("freq_hz", "freq", "frequency"), pick("z_re", "zreal", "re"), pick("z_im", "zimag", "im"), pick("z_mod", "zmod", "mod"), pick("phase", "zphz", "phase_deg")
    if re is None or im is None:
        re, im = mod * F.cos(F.radians(deg)), mod * F.sin(F.radians(deg))
    out = df.select(F.col(names["segment"]).cast("int").alias("segment"), f.alias("freq_hz"), re.alias("z_re"), im.alias("z_im"))
    largest = out.groupBy("segment").agg(F.max(F.sqrt(F.col("z_re") ** 2 + F.col("z_im") ** 2)).alias("m")).agg(F.when(F.median("m") > 20, 1e-3).otherwise(1.0).alias("unit"))
    return out.join(F.broadcast(largest)).select("segment", "freq_hz", (F.col("z_re") * F.col("unit")).alias("z_re"), (F.col("z_im") * F.col("unit")).alias("z_im"))


def spectrum_lines(spark: SparkSession, path: str) -> DataFrame:
    """(segment, freq_hz, z_re, z_im) from a folder of `z<segment>.csv` with lines `f= .. Hz z= a+bi`."""
    z = rf"f\s*=\s*{NUMBER}\s*Hz.*?z\s*=\s*{NUMBER}\s*([-+])\s*{NUMBER}\s*[ij]"
    found = lines(spark, path).where(F.col("line").rlike(z))
    sign = F.when(F.regexp_extract("line", z, 3) == "-", -1.0).otherwise(1.0)
    return found.select(F.regexp_extract("path", r"z(\d+)\.[a-z]+$", 1).cast("int").alias("segment"), *[number(F.regexp_extract("line", z, i)).alias(n) for i, n in ((1, "freq_hz"), (2, "z_re"))], (sign * number(F.regexp_extract("line", z, 4))).alias("z_im"))


def potentiostat(spark: SparkSession, path: str) -> DataFrame:
    """(path, point, freq_hz, z_re, z_im) of the ZCURVE table of `.DTA` files."""
    numbered = lines(spark, path)
    start = numbered.where(F.col("line").startswith("ZCURVE")).groupBy("path").agg(F.min("line_no").alias("begin"))
    header = numbered.join(start, "path").where(F.col("line_no") == F.col("begin") + 1).select("path", F.transform(F.split("line", "\t"), lambda c: F.trim(c)).alias("names"))
    rows = numbered.join(start, "path").where(F.col("line_no") > F.col("begin") + 2).join(header, "path").withColumn("cells", F.split("line", "\t"))
    cell = lambda name: number(F.get("cells", F.array_position("names", name).cast("int") - 1))
    return rows.select("path", cell("Pt").cast("int").alias("point"), cell("Freq").alias("freq_hz"), cell("Zreal").alias("z_re"), cell("Zimag").alias("z_im")).where("freq_hz IS NOT NULL")


def calibration_steps(spark: SparkSession, path: str) -> DataFrame:
    """(path, segment, pair, i, u) of calibration records: five pairs of current and voltage a segment."""
    pairs = F.arrays_zip(F.regexp_extract_all("line", F.lit(rf"i_s\s*=\s*{NUMBER}"), F.lit(1)).alias("i"), F.regexp_extract_all("line", F.lit(rf"u_s\s*=\s*{NUMBER}"), F.lit(1)).alias("u"))
    found = lines(spark, path).where(F.col("line").rlike(r"^s\d+:"))
    out = found.select("path", F.regexp_extract("line", r"^s(\d+):", 1).cast("int").alias("segment"), F.posexplode(pairs).alias("pair", "p"))
    return out.select("path", "segment", "pair", number(F.col("p.i")).alias("i"), number(F.col("p.u")).alias("u"))


def coefficient_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(number, c0, c1) of headerless `c0;c1` files; the row number, from 1, is the segment or sensor."""
    cells = F.split("line", ";")
    found = lines(spark, path).where(F.col("line").rlike(r"\d"))
    return found.select((F.row_number().over(Window.partitionBy("path").orderBy("line_no"))).alias("number"), number(F.get(cells, 0)).alias("c0"), number(F.get(cells, 1)).alias("c1"))


def key_values(spark: SparkSession, path: str) -> DataFrame:
    """(path, key, value) of `Key: Value` sidecars."""
    parts = F.split("line", ":", 2)
    return lines(spark, path).where(F.col("line").contains(":")).select("path", F.trim(F.get(parts, 0)).alias("key"), F.trim(F.get(parts, 1)).alias("value"))


def ragged(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """A table whose last column may hold separators."""
    cells = F.split("line", sep, len(columns))
    return lines(spark, path).where((F.col("line_no") > 0) & (F.trim("line") != "")).select(*[F.trim(F.get(cells, i)).alias(c) for i, c in enumerate(columns)])


def magic(spark: SparkSession, path: str, n: int = 16) -> DataFrame:
    """(path, kind) of files by their first bytes."""
    head = F.substring("content", 1, n)
    kinds = {"recording": b"|CD", "mdf4": b"MDF", "parquet": b"PAR1", "zip": b"PK\x03\x04", "gzip": b"\x1f\x8b"}
    kind = F.lit("unknown")
    for name, start in kinds.items():
        kind = F.when(F.substring(head, 1, len(start)) == F.lit(bytearray(start)), F.lit(name)).otherwise(kind)
    return spark.read.format("binaryFile").load(path).select("path", "length", kind.alias("kind"))


def point_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, t, channel, role, value, shift_s, unit) of logger point files: tab-separated, `timestamp` and the channels' names in the first line, `timeshifts` and
    each channel's acquisition instant within a row, in microseconds, in the second.

    t counts from a file's first row, in seconds. Temperatures are degrees where the median over a file's sensors of their medians is above 15, else volts.
    Files without both header lines have no rows.
    """
    cells = lines(spark, path).where(F.trim("line") != "").select("path", "line_no", F.transform(F.split("line", "\t"), lambda c: F.trim(c)).alias("cells"))
    first = F.lower(F.ltrim(F.get("cells", F.lit(0)), F.lit("\ufeff")))
    head = cells.where((F.col("line_no") < 2) & first.isin("timestamp", "timeshifts")).groupBy("path").agg(F.max(F.when(first == "timestamp", F.col("cells"))).alias("names"), F.max(F.when(first == "timeshifts", F.col("cells"))).alias("shifts"))
    head = head.where((F.size("names") == F.size("shifts")) & (F.size("names") > 1))
    instant = F.unix_micros(F.try_to_timestamp(F.regexp_replace(F.get("cells", F.lit(0)), ",", "."), F.lit("yyyy.MM.dd HH:mm:ss[.SSSSSS][.SSS]")))
    rows = cells.where("line_no > 1").join(head, "path").withColumn("at", instant).where("at IS NOT NULL")
    zipped = F.slice(F.arrays_zip("names", "shifts", "cells"), F.lit(2), F.size("names") - 1)
    tall = rows.select("path", "at", F.explode(zipped).alias("c")).select("path", "at", F.col("c.names").alias("channel"), number(F.col("c.shifts")).alias("shift"), number(F.col("c.cells")).alias("value"))
    role = F.when(F.col("channel").rlike(r"(?i)^(s|seg|segment)?[ _]?\d+$"), "segment").when(F.lower("channel").startswith("temp"), "temperature").otherwise("other")
    tall = tall.withColumn("role", role)
    begun = tall.groupBy("path").agg(F.min("at").alias("begin"))
    warm = tall.where("role = 'temperature'").groupBy("path", "channel").agg(F.median("value").alias("m")).groupBy("path").agg(F.when(F.median("m") > 15, "degC").otherwise("V").alias("warm"))
    out = tall.join(begun, "path").join(warm, "path", "left")
    unit = F.when(F.col("role") == "temperature", F.col("warm"))
    return out.select("path", ((F.col("at") - F.col("begin")) / 1e6).alias("t"), "channel", "role", "value", (F.col("shift") / 1e6).alias("shift_s"), unit.alias("unit"))


def _cells_of(spark: SparkSession, path: str) -> DataFrame:
    return lines(spark, path).where(~F.trim("line").startswith("#")).select(F.filter(F.transform(F.split("line", r"[;,\t]"), lambda c: F.trim(c)), lambda x: x != "").alias("cells"))


def gain_table(spark: SparkSession, path: str) -> DataFrame:
    """(segment, freq_hz, re, im) of a chain's response; segment is null for the curve that all share (`all` or `0`). Headers and unreadable lines are left out."""
    cell = lambda i: F.get("cells", F.lit(i))
    read = _cells_of(spark, path).select(F.lower(cell(0)).alias("s"), *[cell(i).try_cast("double").alias(n) for i, n in ((1, "freq_hz"), (2, "re"), (3, "im"))]).where("freq_hz IS NOT NULL AND re IS NOT NULL AND im IS NOT NULL")
    own = F.when(~F.col("s").isin("all", "0"), F.col("s").try_cast("int"))
    return read.where(F.col("s").isin("all", "0") | own.isNotNull()).select(own.alias("segment"), "freq_hz", "re", "im")


def area_table(spark: SparkSession, path: str) -> DataFrame:
    """(segment, area_cm2) of a table of areas, those above 0 only."""
    read = _cells_of(spark, path).select(F.get("cells", F.lit(0)).try_cast("int").alias("segment"), F.get("cells", F.lit(1)).try_cast("double").alias("area_cm2"))
    return read.where("segment IS NOT NULL AND area_cm2 > 0")


def write_gain_table(gains: DataFrame, path: str) -> None:
    """Writes (segment, freq_hz, re, im) as gain_table() reads it; a null segment is `all`."""
    rows = gains.select(F.coalesce(F.col("segment").cast("string"), F.lit("all")).alias("segment"), "freq_hz", F.col("re").alias("gain_real"), F.col("im").alias("gain_imag"))
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_potentiostat(sweeps: DataFrame, path: str) -> None:
    """Writes a file with a ZCURVE table, as potentiostat() reads it, for each `sweep`: (sweep, point, freq_hz, z_re, z_im). A sweep has some hundred points."""
    line = F.concat_ws("\t", F.lit(""), *[F.col(c).cast("string") for c in ("point", "freq_hz", "z_re", "z_im")])
    body = sweeps.groupBy("sweep").agg(F.array_sort(F.collect_list(F.struct("point", line.alias("line")))).alias("rows"))
    head = "EXPLAIN\nTAG\tEISGALV\nZCURVE\tTABLE\n\tPt\tFreq\tZreal\tZimag\n\t#\tHz\tohm\tohm\n"
    body.select("sweep", F.concat(F.lit(head), F.array_join(F.transform("rows", lambda r: r["line"]), "\n")).alias("value")).write.mode("overwrite").partitionBy("sweep").text(path)
