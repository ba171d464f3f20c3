"""Grid files written and read, and files put together by hand."""

import glob
import io
import struct
import zipfile
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormledger.operators import grid
from stormledger.sources import arrays

T0 = datetime(2024, 1, 31, 20)


@pytest.fixture(scope="module")
def steps(spark):
    arrays.register(spark)
    rows = [(T0 + timedelta(hours=h), [-20.0, -19.75], [-45.0, -44.75, -44.5], [h + k / 8 for k in range(6)], [None if (h + k) % 9 == 0 else float(k) for k in range(6)]) for h in range(60)]
    return spark.createDataFrame(rows, arrays.SCHEMA)


def test_rows_come_back(spark, steps, tmp_path):
    path = str(tmp_path / "grid")
    steps.repartition(3).write.format(arrays.FORMAT).mode("append").save(path)
    assert glob.glob(f"{path}/*.zip") and not glob.glob(f"{path}/.staging*")
    back = spark.read.format(arrays.FORMAT).option("steps", 7).load(path)
    assert sorted(back.collect()) == sorted(steps.collect())
    one = next(iter(glob.glob(f"{path}/*.zip")))
    assert spark.read.format(arrays.FORMAT).load(one).count() > 0
    cells = lambda df: sorted(map(tuple, grid.grid_rows(df).collect()), key=str)
    assert cells(back) == cells(steps)


def test_a_range_reads_only_its_steps(spark, steps, tmp_path):
    path = str(tmp_path / "grid")
    steps.coalesce(1).write.format(arrays.FORMAT).mode("append").save(path)
    low, high = T0 + timedelta(hours=10), T0 + timedelta(hours=13)
    part, back = arrays.read(spark, path, low, high, steps=5), arrays.read(spark, path, steps=5)
    assert sorted(r.valid_time for r in part.collect()) == [low + timedelta(hours=h) for h in range(4)]
    # Steps 10 to 13 are in one month and one partition; the unbounded table is not cut by them.
    assert part.rdd.getNumPartitions() == 1 and back.rdd.getNumPartitions() >= 12 and back.count() == 60
    late = back.filter(F.col("valid_time") >= F.lit(high).cast("timestamp_ntz"))
    assert late.count() == 47 and back.count() == 60
    reader = arrays.GridReader({"path": path, "steps": "5", "until": high.isoformat()})
    assert [(p.first, p.last) for p in reader.partitions()][-1][1] == high
    assert arrays.read(spark, path, until=T0 - timedelta(hours=1)).count() == 0


def records(version):
    """Two record variables that take turns, packed as shorts with a fill value."""
    wide = version == 5
    n = lambda x: struct.pack(">q" if wide else ">i", x)
    tag = lambda t, k: struct.pack(">i", t) + n(k)
    text = lambda s: n(len(s)) + s.encode() + b"\0" * (-len(s) % 4)
    offset = lambda x: struct.pack(">i" if version == 1 else ">q", x)
    att = lambda name, kind, raw, k: text(name) + struct.pack(">i", kind) + n(k) + raw + b"\0" * (-len(raw) % 4)
    hours = att("units", 2, b"hours since 1900-01-01 00:00:00.0", 33)
    packed = att("scale_factor", 6, struct.pack(">d", 0.5), 1) + att("add_offset", 6, struct.pack(">d", 10.0), 1) + att("_FillValue", 3, struct.pack(">h", -1), 1)

    def build(at):
        out = b"CDF" + bytes([version]) + n(3) + tag(10, 3) + text("time") + n(0) + text("latitude") + n(1) + text("longitude") + n(3) + tag(0, 0) + tag(11, 4)
        out += text("latitude") + n(1) + n(1) + tag(0, 0) + struct.pack(">i", 5) + n(4) + offset(at)
        out += text("longitude") + n(1) + n(2) + tag(0, 0) + struct.pack(">i", 5) + n(12) + offset(at + 4)
        out += text("time") + n(1) + n(0) + tag(12, 1) + hours + struct.pack(">i", 4) + n(4) + offset(at + 16)
        out += text("tp") + n(3) + n(0) + n(1) + n(2) + tag(12, 3) + packed + struct.pack(">i", 3) + n(8) + offset(at + 20)
        return out

    at = len(build(0))
    body = struct.pack(">f3f", -20.0, -45.0, -44.5, -44.0)
    for r in range(3):
        body += struct.pack(">i", 1_087_000 + r) + struct.pack(">3h", r, 2 * r, -1) + b"\0\0"
    return build(at) + body


@pytest.mark.parametrize("version", [1, 2, 5])
def test_packed_records_of_all_versions(spark, tmp_path, version):
    arrays.register(spark)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("rain.nc", records(version))
        z.writestr("readme.txt", "not an array file")
    rows = spark.read.format(arrays.FORMAT).load(str(tmp_path)).orderBy("valid_time").collect()
    first = datetime(1900, 1, 1) + timedelta(hours=1_087_000)
    assert [r.valid_time for r in rows] == [first + timedelta(hours=k) for k in range(3)]
    assert [list(r.tp) for r in rows] == [[10.0 + r / 2, 10.0 + r, None] for r in range(3)]
    assert rows[0].longitude == [-45.0, -44.5, -44.0] and rows[0].fg10 is None


def test_other_files_are_no_array_files():
    with pytest.raises(ValueError, match="classic"):
        arrays.header(io.BytesIO(b"\x89HDF\r\n\x1a\n" + b"\0" * 64))
    f = io.BytesIO(arrays.encode([T0], [1.0], [2.0, 3.0], "tp", np.array([[[5.0, 6.0]]])))
    assert arrays.header(f)["tp"].read(f).tolist() == [[[5.0, 6.0]]]
