"""Dialects of recordings, and files that a filter keeps closed."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltplane.sources import recordings


def packed(names, x, fs, cr="", cb=""):
    body = np.ascontiguousarray(x, "<f4").tobytes()
    head = f"|CF,2,1,1;|CK,1,3,1,1;|CD,1,{1 / fs!r},1,1,s,0,0,0;{cb}|CR,1,{len(names)}{cr};|NT,1,16,1,3,2024,7,45,46.0;|CP,1,9,9,9," + ",".join(f"7,32,{n}" for n in names) + f";|CS,1,{len(body) // 2 // (4 * len(names)) * 4 * len(names)},"
    return head.encode("latin-1") + body


def by_channel(names, x, fs, width=8, other=None):
    body = np.ascontiguousarray(x, f"<f{width}").tobytes()
    head = "|CF,2,1,1;" + "".join(f"|CN,1,20,{i},0,0,{len(n)},{n},0,;|CD,1,10,{1 / (other if other and i else fs)!r},1,1,s;" for i, n in enumerate(names)) + f"|CP,1,16,1,{width},7,64,0,0;|CS,1,{len(body)},"
    return head.encode("latin-1") + body


def read(spark, path, **options):
    recordings.register(spark)
    return spark.read.format("recording").options(**options).load(str(path))


def joined(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r.first_sample):
        out.setdefault(r.channel, []).extend(r.samples)
    return out


def test_dialects(spark, tmp_path):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(1000, 3)).astype("<f4")
    names = ["UC1", "7", "Temp_ä"]
    (tmp_path / "packed.dat").write_bytes(packed(names, x, 2000.0, ",2.5,-1,V", "|Cb,1,0,0,0,0,0,0,0,0,0,12.5,x;"))
    (tmp_path / "wide.dat").write_bytes(by_channel(names, x, 2000.0))
    (tmp_path / "narrow.dat").write_bytes(by_channel(names, x, 2000.0, 4) + b"abc")
    recordings.write_recording(str(tmp_path / "plain.dat"), names, x, 2000.0, "today")
    for name in ("packed", "wide", "narrow", "plain"):
        rows = read(spark, tmp_path / f"{name}.dat", chunk=300).collect()
        got = joined(rows)
        assert list(sorted(got)) == sorted(names) and all(np.array_equal(np.array(got[n], "<f4"), x[:, i]) for i, n in enumerate(names)), name
        assert {r.fs for r in rows} == {2000.0} and {r.role for r in rows} == {"cell_voltage", "segment", "temperature"}
        assert {(r.factor, r.offset, r.x_offset) for r in rows} == {(2.5, -1.0, 12.5) if name == "packed" else (1.0, 0.0, 0.0)}
    cut = (tmp_path / "wide.dat").read_bytes()[:-30]
    (tmp_path / "cut.dat").write_bytes(cut)
    assert {len(v) for v in joined(read(spark, tmp_path / "cut.dat").collect()).values()} == {998}


@pytest.mark.parametrize(("raw", "says"), [(b"nothing", "no recording header"), (by_channel(["a", "b"], np.zeros((3, 2)), 10.0, other=20.0), "different sample intervals"), (packed(["a", "b"], np.zeros((4, 2)), 10.0).replace(b"|CR,1,2", b"|CR,1,5"), "5 channels, but 2 names"), (by_channel(["a"], np.zeros((3, 1)), 10.0).replace(b"|CP,1,16,1,8", b"|CP,1,16,1,2"), "values of 2 bytes")])
def test_headers_that_contradict_themselves(raw, says):
    with pytest.raises(ValueError, match=says):
        recordings.parse_header(raw, len(raw))


def test_files_beyond_a_filter_stay_closed(spark, tmp_path):
    x = np.arange(20.0).reshape(10, 2)
    for i in range(6):
        recordings.write_recording(str(tmp_path / f"k{i}.dat"), ["UC1", str(i)], x + i, 100.0 * (1 + i % 2), f"day {i}")
    (tmp_path / "notes.dat").write_bytes(b"no recording")
    table = recordings.index(spark, str(tmp_path / "*.dat"))
    assert table.count() == 6
    table.write.parquet(str(tmp_path / "index"))
    # what is opened from here on fails, but for the second and the fifth file
    for i in (0, 2, 3, 5):
        (tmp_path / f"k{i}.dat").write_bytes(b"broken")
    known = spark.read.parquet(str(tmp_path / "index"))
    chosen = lambda kept, *channels: recordings.read_chosen(known.where(kept), list(channels) or None, chunk=3, per_task=1)
    assert {r.path[-6:] for r in chosen(F.arrays_overlap("channels", F.array(F.lit("1"), F.lit("4"))), "1", "4").collect()} == {"k1.dat", "k4.dat"}
    got = chosen("start = 'day 4'", "UC1").orderBy("first_sample").collect()
    assert [r.first_sample for r in got] == [0, 3, 6, 9] and sum((list(r.samples) for r in got), []) == (x[:, 0] + 4).tolist()
    assert chosen("start >= 'day 4' and start < 'day 5'").select("channel").distinct().count() == 2
    assert chosen("start = 'day 1' and fs > 150").count() == 8 and chosen("fs > 1000").count() == 0
    with pytest.raises(Exception, match="no recording header"):
        chosen("start = 'day 0'").collect()
    wanted = spark.createDataFrame([("day 1",), ("day 9",), (None,)], "start string")
    assert sorted(str(r.start) for r in recordings.missing(wanted, table.where("start = 'day 1'"), ["start"]).collect()) == ["None", "day 9"]
