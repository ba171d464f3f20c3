"""Monthly grid files as they are delivered: zips whose members are classic array files.

``register(spark)`` adds the format ``grid_months``: a row per time step, with the
axes and one array of values per variable, as ``grid.grid_rows`` takes them.
Variables lie in members of their own and meet by time. A partition is a file
and some of its time steps; the options ``since`` and ``until`` leave out all other
steps, so only the bytes of those in the range are read (``read`` sets them).
Conditions of a query are not pushed by themselves: Spark 4.1 keeps what was pushed
for one query with the loaded table, and the next query would miss rows. Files are
opened by the file system that their address names.

Members are files of the classic format in any of its three versions (32-bit,
64-bit offsets, 64-bit data), with or without a record dimension; other members
are passed over. Packed values are unpacked, fill values are null. Written files
have one zip per month and task and appear when the whole write is done.
"""

from __future__ import annotations

import io
import struct
import sys
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

FORMAT = "grid_months"
SCHEMA = "valid_time timestamp_ntz, latitude array<double>, longitude array<double>, tp array<double>, fg10 array<double>"
VARIABLES = ("tp", "fg10")
TIME_NAMES = ("valid_time", "time")
#: Time steps of a partition, unless the option ``steps`` says otherwise.
STEPS = 168
EPOCH = datetime(1970, 1, 1)
# Fixed values of the classic format: types by number, and tags of its lists.
TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12


@dataclass
class Variable:
    shape: tuple[int, ...]
    names: tuple[str, ...]
    attributes: dict
    kind: np.dtype
    begin: int
    step: int  # bytes from one index of the first dimension to the next

    def read(self, f, first: int = 0, past: int | None = None) -> np.ndarray:
        """Values at some indices of the first dimension; only their bytes are read."""
        past = (self.shape[0] if self.shape else 1) if past is None else past
        inner = self.shape[1:]
        size = int(np.prod(inner, dtype=np.int64)) * self.kind.itemsize
        if self.step == size:
            f.seek(self.begin + first * size)
            raw = f.read((past - first) * size)
        else:  # records of several variables take turns
            raw = b"".join(self._at(f, i, size) for i in range(first, past))
        values = np.frombuffer(raw, self.kind).reshape((past - first, *inner))
        fill = [self.attributes[k] for k in ("_FillValue", "missing_value") if k in self.attributes]
        out = values.astype(np.float64)
        gone = np.isin(values, np.concatenate(fill).astype(self.kind)) if fill else np.zeros(values.shape, bool)
        out = out * float(self.attributes.get("scale_factor", [1])[0]) + float(self.attributes.get("add_offset", [0])[0])
        out[gone] = np.nan
        return out

    def _at(self, f, i: int, size: int) -> bytes:
        f.seek(self.begin + i * self.step)
        return f.read(size)


def header(f) -> dict[str, Variable]:
    """The variables of a classic array file."""
    f.seek(0)
    magic = f.read(4)
    if magic[:3] != b"CDF" or magic[3] not in (1, 2, 5):
        raise ValueError("not a classic array file")
    wide = magic[3] == 5

    def number() -> int:
        return struct.unpack(">q" if wide else ">i", f.read(8 if wide else 4))[0]

    def text() -> str:
        n = number()
        return f.read(n + -n % 4)[:n].decode()

    def tagged() -> int:
        struct.unpack(">i", f.read(4))
        return number()

    def attributes() -> dict:
        out = {}
        for _ in range(tagged()):
            name = text()
            kind = np.dtype(TYPES[struct.unpack(">i", f.read(4))[0]])
            n = number() * kind.itemsize
            raw = f.read(n + -n % 4)[:n]
            out[name] = raw.decode(errors="replace") if kind.kind == "S" else np.frombuffer(raw, kind)
        return out

    records = number()
    dims = [(text(), number()) for _ in range(tagged())]
    attributes()
    found, sizes = {}, []
    for _ in range(tagged()):
        name, ids = text(), None
        ids = [number() for _ in range(number())]
        own = attributes()
        kind = np.dtype(TYPES[struct.unpack(">i", f.read(4))[0]])
        number()
        begin = struct.unpack(">i", f.read(4))[0] if magic[3] == 1 else struct.unpack(">q", f.read(8))[0]
        is_record = bool(ids) and dims[ids[0]][1] == 0
        shape = tuple(records if dims[i][1] == 0 else dims[i][1] for i in ids)
        size = int(np.prod(shape[1:], dtype=np.int64)) * kind.itemsize
        found[name] = Variable(shape, tuple(dims[i][0] for i in ids), own, kind, begin, -1 if is_record else size)
        if is_record:
            sizes.append(size)
    padded = sizes[0] if len(sizes) == 1 else sum(n + -n % 4 for n in sizes)
    for v in found.values():
        v.step = padded if v.step < 0 else v.step
    return found


def instants(values: np.ndarray, units: str) -> list[datetime]:
    """Moments from numbers and units such as "hours since 1900-01-01 00:00"."""
    unit, _, origin = units.partition(" since ")
    start = datetime.fromisoformat(origin.strip().removesuffix("Z").removesuffix(" UTC"))
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.strip().rstrip("s")]
    return [start + timedelta(seconds=round(float(v) * seconds)) for v in values]


def encode(times: list[datetime], latitude, longitude, name: str, values: np.ndarray) -> bytes:
    """A classic array file, 64-bit offsets, with one variable over time, latitude and longitude."""
    axes = {"valid_time": (np.array([(t - EPOCH).total_seconds() for t in times], ">f8"), "seconds since 1970-01-01"), "latitude": (np.array(latitude, ">f8"), "degrees_north"), "longitude": (np.array(longitude, ">f8"), "degrees_east")}
    text = lambda s: struct.pack(">i", len(s)) + s.encode() + b"\0" * (-len(s) % 4)
    units = lambda s: struct.pack(">ii", ATTRIBUTE, 1) + text("units") + struct.pack(">i", 2) + text(s)
    body = [*[(k, [i], a, u) for i, (k, (a, u)) in enumerate(axes.items())], (name, [0, 1, 2], np.asarray(values, ">f8"), "1")]

    def head(begins: list[int]) -> bytes:
        out = b"CDF\x02" + struct.pack(">i", 0) + struct.pack(">ii", DIMENSION, 3)
        out += b"".join(text(k) + struct.pack(">i", len(a)) for k, (a, _) in axes.items())
        out += struct.pack(">ii", 0, 0) + struct.pack(">ii", VARIABLE, len(body))
        for (k, ids, a, u), at in zip(body, begins):
            out += text(k) + struct.pack(f">i{len(ids)}i", len(ids), *ids) + units(u) + struct.pack(">iiq", 6, min(a.nbytes, 2**31 - 4), at)
        return out

    at, begins = len(head([0] * len(body))), []
    for _, _, a, _ in body:
        begins.append(at)
        at += a.nbytes
    return head(begins) + b"".join(a.tobytes() for _, _, a, _ in body)


def _system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _files(path: str) -> list[str]:
    """Zips of a folder, or the file itself."""
    from pyarrow import fs

    system, inner = _system(path)
    if system.get_file_info(inner).type == fs.FileType.File:
        return [inner]
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(x.path for x in found if x.type == fs.FileType.File and x.path.endswith(".zip") and "/." not in x.path)


class Month:
    """One zip: where each variable lies, and at which time steps."""

    def __init__(self, path: str, file: str):
        self.zip = zipfile.ZipFile(_system(path)[0].open_input_file(file))
        self.members: dict[str, tuple[str, dict[str, Variable], list[datetime]]] = {}
        for info in self.zip.infolist():
            with self.zip.open(info) as f:
                try:
                    variables = header(f)
                except ValueError:
                    continue
                time = next(variables[n] for n in TIME_NAMES if n in variables)
                steps = instants(time.read(f), time.attributes["units"])
                for name in VARIABLES:
                    if name in variables:
                        self.members[name] = (info.filename, variables, steps)
        self.times = sorted({t for _, _, steps in self.members.values() for t in steps})

    def rows(self, first: datetime, last: datetime) -> Iterator[tuple]:
        """Steps from ``first`` to ``last``, both included; a variable that lacks a step is null there."""
        values: dict[str, dict[datetime, np.ndarray]] = {}
        axes: dict[str, list[float]] = {}
        for name, (member, variables, steps) in self.members.items():
            wanted = [i for i, t in enumerate(steps) if first <= t <= last]
            with self.zip.open(member) as f:
                for axis in ("latitude", "longitude"):
                    axes[axis] = variables[axis].read(f).tolist()
                block = variables[name].read(f, wanted[0], wanted[-1] + 1) if wanted else []
                values[name] = {steps[wanted[0] + k]: v.reshape(-1) for k, v in enumerate(block)}
        plain = lambda v: None if v is None else [None if np.isnan(x) else x for x in v.tolist()]
        for t in (t for t in self.times if first <= t <= last):
            yield (t, axes["latitude"], axes["longitude"], *[plain(values.get(name, {}).get(t)) for name in VARIABLES])


@dataclass
class Steps(InputPartition):
    file: str
    first: datetime
    last: datetime


class GridReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.steps = options["path"], int(options.get("steps", STEPS))
        self.low = datetime.fromisoformat(options.get("since", datetime.min.isoformat()))
        self.high = datetime.fromisoformat(options.get("until", datetime.max.isoformat()))

    def partitions(self):
        found = []
        for file in _files(self.path):
            times = [t for t in Month(self.path, file).times if self.low <= t <= self.high]
            found += [Steps(file, times[k], times[min(k + self.steps, len(times)) - 1]) for k in range(0, len(times), self.steps)]
        return found

    def read(self, partition):
        if isinstance(partition, Steps):
            yield from Month(self.path, partition.file).rows(partition.first, partition.last)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class GridWriter(DataSourceWriter):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.staging = f".staging-{uuid.uuid4().hex}"

    def write(self, iterator):
        system, inner = _system(self.path)
        system.create_dir(f"{inner}/{self.staging}", recursive=True)
        months: dict[str, list] = {}
        for row in iterator:
            months.setdefault(row["valid_time"].strftime("%Y%m"), []).append(row)
        names = []
        for month, rows in sorted(months.items()):
            rows.sort(key=lambda r: r["valid_time"])
            out, first = io.BytesIO(), rows[0]
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                for name in VARIABLES:
                    shape = (len(rows), len(first["latitude"]), len(first["longitude"]))
                    values = np.array([r[name] for r in rows], np.float64).reshape(shape)
                    z.writestr(f"{name}.nc", encode([r["valid_time"] for r in rows], first["latitude"], first["longitude"], name, values))
            names.append(f"grid-{month}-{uuid.uuid4().hex}.zip")
            with system.open_output_stream(f"{inner}/{self.staging}/{names[-1]}") as f:
                f.write(out.getvalue())
        return Written(names)

    def commit(self, messages):
        system, inner = _system(self.path)
        for name in (n for m in messages if m is not None for n in m.files):
            system.move(f"{inner}/{self.staging}/{name}", f"{inner}/{name}")
        self.abort(messages)

    def abort(self, messages):
        from pyarrow import fs

        system, inner = _system(self.path)
        if system.get_file_info(f"{inner}/{self.staging}").type == fs.FileType.Directory:
            system.delete_dir(f"{inner}/{self.staging}")


class GridMonths(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return GridReader(self.options)

    def writer(self, schema, overwrite):
        return GridWriter(self.options)


def register(spark: SparkSession) -> None:
    """Add the format to a session; its code travels with each job, so executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(GridMonths)


def read(spark: SparkSession, path: str, since: datetime | None = None, until: datetime | None = None, steps: int = STEPS) -> DataFrame:
    """Time steps of the files at a path, from ``since`` to ``until``, both included."""
    register(spark)
    reader = spark.read.format(FORMAT).option("steps", steps)
    for name, at in (("since", since), ("until", until)):
        reader = reader if at is None else reader.option(name, at.isoformat())
    return reader.load(path)
