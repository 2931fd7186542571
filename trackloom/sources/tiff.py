"""TIFF stacks: a row per plane in, a file per stack out.

`read_stacks` goes through Spark's binaryFile source, so any store that Spark reads will do; a file is one task's work
and at most 2 GB. The other ways open files at offsets, in stores that tasks can open (`files.opened`), so a file may have
any size: `plane_index` follows each file's chain of planes in a task and gives a small row per plane, which is filtered,
joined and dealt like any other before `read_planes` (or `plans.stacks`) reads the planes that are left; the data source
`tiff_stack` deals ranges of all planes to tasks. It doesn't take filters: Spark 4.1 keeps those that a Python source has
taken for later reads of the same relation, so filters belong on an index. Planes leave as Arrow batches.

Understood are classic and large files, strips and tiles, no compression, deflate, LZW and PackBits, horizontal
differences, whole numbers of 8 to 64 bits and floats of 16 to 64, one sample per pixel, any number of planes. Anything
else is an error that names what is missing.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from trackloom.sources.files import FolderWriter, listed, opened

#: Fixed values of the format: tag numbers, bytes and codes of field types, array kinds of sample formats, compressions.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, SAMPLES, ROWS, COUNTS, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, FORMAT = 256, 257, 258, 259, 262, 273, 277, 278, 279, 317, 322, 323, 324, 325, 339
FIELD_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 16: 8}
FIELD_CODES = {1: "B", 3: "H", 4: "I", 16: "Q"}
KINDS = {1: "u", 2: "i", 3: "f"}
NO_COMPRESSION, LZW, DEFLATE, PACKBITS = 1, 5, (8, 32946), 32773

PLANES = "path string, frame int, height int, width int, pixels array<double>"
#: Bytes from an offset: (offset, number) -> bytes.
Read = Callable[[int, int], bytes]


def decode(content: bytes) -> Iterator[np.ndarray]:
    """The planes of a file, in order."""
    read = lambda at, n: content[at : at + n]
    order, large, _ = _header(read)
    for at in directories(read):
        yield plane(read, at, order, large)


def _header(read: Read) -> tuple[str, bool, int]:
    """(byte order, whether offsets have 8 bytes, where the first plane's fields are)."""
    order = {b"II": "<", b"MM": ">"}.get(read(0, 2))
    version = struct.unpack(order + "H", read(2, 2))[0] if order else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    return order, version == 43, struct.unpack(order + "Q", read(8, 8))[0] if version == 43 else struct.unpack(order + "I", read(4, 4))[0]


def directories(read: Read) -> Iterator[int]:
    """Where each plane's fields are."""
    order, large, at = _header(read)
    seen: set[int] = set()
    while at:
        if at in seen:
            raise ValueError("the chain of planes is a circle")
        seen.add(at)
        yield at
        n = struct.unpack(order + ("Q" if large else "H"), read(at, 8 if large else 2))[0]
        after = at + (8 + 20 * n if large else 2 + 12 * n)
        at = struct.unpack(order + ("Q" if large else "I"), read(after, 8 if large else 4))[0]


def _fields(read: Read, at: int, order: str, large: bool) -> dict[int, tuple]:
    n = struct.unpack(order + ("Q" if large else "H"), read(at, 8 if large else 2))[0]
    length, inline, number = (20, 8, "Q") if large else (12, 4, "I")
    raw, found = read(at + (8 if large else 2), length * n), {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HH" + number, raw, length * i)
        size, value = FIELD_BYTES.get(kind, 0) * count, raw[length * (i + 1) - inline : length * (i + 1)]
        if kind in FIELD_CODES:
            if size > inline:
                value = read(struct.unpack(order + number, value)[0], size)
            found[tag] = struct.unpack_from(f"{order}{count}{FIELD_CODES[kind]}", value)
    return found


def plane(read: Read, at: int, order: str, large: bool) -> np.ndarray:
    tags = _fields(read, at, order, large)
    one = lambda tag, default: (tags.get(tag) or (default,))[0]
    bits, kind, compression, predictor = one(BITS, 1), KINDS.get(one(FORMAT, 1)), one(COMPRESSION, NO_COMPRESSION), one(PREDICTOR, 1)
    if one(SAMPLES, 1) != 1 or predictor not in (1, 2) or not {OFFSETS, TILE_OFFSETS} & set(tags):
        raise ValueError("only single samples, plain or as horizontal differences, are understood")
    if kind is None or bits not in (8, 16, 32, 64) or (kind == "f" and predictor == 2) or compression not in (NO_COMPRESSION, LZW, *DEFLATE, PACKBITS):
        raise ValueError(f"sample format {one(FORMAT, 1)} of {bits} bits, compression {compression} is not understood")
    dtype, height, width = np.dtype(f"{order}{kind}{bits // 8}"), one(HEIGHT, 0), one(WIDTH, 0)
    tiled = TILE_OFFSETS in tags
    block_h, block_w = (one(TILE_HEIGHT, height), one(TILE_WIDTH, width)) if tiled else (min(one(ROWS, height), height), width)
    across = -(-width // block_w) if width else 0
    out = np.zeros((height, width), dtype)
    for k, (offset, n) in enumerate(zip(tags[TILE_OFFSETS if tiled else OFFSETS], tags[TILE_COUNTS if tiled else COUNTS])):
        top, left = k // across * block_h, k % across * block_w
        rows = block_h if tiled else min(block_h, height - top)
        block = np.frombuffer(_expanded(read(offset, n), compression), dtype, rows * block_w).reshape(rows, block_w)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=dtype.newbyteorder("="))
        part = out[top : top + rows, left : left + block_w]
        part[:] = block[: part.shape[0], : part.shape[1]]
    return out


def _expanded(raw: bytes, compression: int) -> bytes:
    if compression in DEFLATE:
        return zlib.decompress(raw)
    return _unlzw(raw) if compression == LZW else _unpackbits(raw) if compression == PACKBITS else raw


def _unpackbits(raw: bytes) -> bytes:
    out, at = bytearray(), 0
    while at < len(raw):
        n = raw[at]
        if n < 128:
            out += raw[at + 1 : at + 2 + n]
            at += 2 + n
        elif n > 128:
            out += raw[at + 1 : at + 2] * (257 - n)
            at += 2
        else:
            at += 1
    return bytes(out)


def _unlzw(raw: bytes) -> bytes:
    """Codes of 9 to 12 bits, the high bits first; 256 clears the table and 257 ends."""
    out, table, last = bytearray(), [], b""
    held = bits = 0
    size = 9
    for byte in raw:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < size:
            continue
        bits -= size
        code = held >> bits & ((1 << size) - 1)
        if code == 257:
            break
        if code == 256:
            table, last, size = [bytes([i]) for i in range(256)] + [b"", b""], b"", 9
            continue
        if code > len(table) or (code == len(table) and not last):
            raise ValueError("broken LZW data")
        word = table[code] if code < len(table) else last + last[:1]
        out += word
        if last:
            table.append(last + word[:1])
        last = word
        size = min(12, max(9, (len(table) + 1).bit_length()))
    return bytes(out)


def encode(planes: list[np.ndarray], compress: bool = True) -> bytes:
    """A little-endian file with a strip per plane."""
    out, link = bytearray(b"II*\0" + bytes(4)), 4
    for plane in planes:
        plane = np.ascontiguousarray(plane, plane.dtype.newbyteorder("<"))
        data = zlib.compress(plane.tobytes()) if compress else plane.tobytes()
        data_at = len(out)
        out += data + bytes(len(data) % 2)
        kind = next(k for k, v in KINDS.items() if v == plane.dtype.kind)
        fields = [
            (WIDTH, 4, plane.shape[1]), (HEIGHT, 4, plane.shape[0]), (BITS, 3, plane.dtype.itemsize * 8),
            (COMPRESSION, 3, DEFLATE[0] if compress else NO_COMPRESSION), (PHOTOMETRIC, 3, 1), (OFFSETS, 4, data_at),
            (SAMPLES, 3, 1), (ROWS, 4, plane.shape[0]), (COUNTS, 4, len(data)), (FORMAT, 3, kind),
        ]
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(fields)) + b"".join(struct.pack("<HHII", tag, t, 1, v) for tag, t, v in sorted(fields))
        link = len(out)
        out += bytes(4)
    return bytes(out)


def read_stacks(spark: SparkSession, path: str | list[str], pattern: str = "*.{tif,tiff}") -> DataFrame:
    """path, frame, height, width, pixels of every file below `path`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for file, content in zip(rows["path"], rows["content"]):
                try:
                    for frame, p in enumerate(decode(content)):
                        yield pd.DataFrame(
                            {"path": [file], "frame": [frame], "height": [p.shape[0]], "width": [p.shape[1]], "pixels": [p.astype(np.float64).reshape(-1)]}
                        )
                except (ValueError, struct.error, zlib.error) as e:
                    raise ValueError(f"{file}: {e}") from e

    return files.select("path", "content").mapInPandas(run, PLANES)


#: Files whose chains of planes a task follows.
FILES_PER_TASK = 8


def plane_index(files: DataFrame) -> DataFrame:
    """files (path and other columns) with a row for each plane: frame, and offset, where the plane's fields are. Only the
    chain of planes is read, some bytes a plane, FILES_PER_TASK files a task."""
    names, files = files.columns, files.persist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, path in enumerate(b.column("path").to_pylist()):
                with opened(path) as f, _naming(path):
                    offsets = list(directories(_from(f)))
                row = [pa.repeat(b.column(c)[i], len(offsets)) for c in names]
                yield pa.RecordBatch.from_arrays([*row, pa.array(range(len(offsets)), pa.int32()), pa.array(offsets, pa.int64())], names=[*names, "frame", "offset"])

    dealt = files.repartition(max(1, -(-files.count() // FILES_PER_TASK)), "path")
    return dealt.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in files.dtypes), "frame int, offset long"]))


class _naming:
    """Says in an error which file it is about."""

    def __init__(self, path: str):
        self.path = path

    def __enter__(self) -> None:
        pass

    def __exit__(self, kind, e, _) -> None:
        if isinstance(e, (ValueError, struct.error, zlib.error)):
            raise ValueError(f"{self.path}: {e}") from e


class PlaneReader:
    """Planes by path and offset; keeps the file that was read last open."""

    def __init__(self):
        self.path, self.file = None, None

    def plane(self, path: str, offset: int) -> np.ndarray:
        if path != self.path:
            self.close()
            self.path, self.file = path, opened(path)
        with _naming(path):
            order, large, _ = _header(_from(self.file))
            return plane(_from(self.file), offset, order, large)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.path = self.file = None

    def __enter__(self) -> PlaneReader:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def as_list(plane: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list of the plane's pixels."""
    values = pa.array(np.ascontiguousarray(plane, plane.dtype.newbyteorder("=")).reshape(-1))
    return pa.ListArray.from_arrays(pa.array([0, plane.size], pa.int32()), values.cast(kind))


#: Spark's names of pixels' types.
PIXELS = {"double": pa.float64(), "float": pa.float32(), "int": pa.int32(), "smallint": pa.int16(), "bigint": pa.int64()}


def read_planes(index: DataFrame, pixels: str = "double") -> DataFrame:
    """index (path, offset and other columns) with height, width and pixels in place of path and offset."""
    names = [c for c in index.columns if c not in ("path", "offset")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with PlaneReader() as reader:
            for b in batches:
                for i, (path, offset) in enumerate(zip(b.column("path").to_pylist(), b.column("offset").to_pylist())):
                    p = reader.plane(path, offset)
                    size = [pa.array([n], pa.int32()) for n in p.shape]
                    yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, 1) for c in names), *size, as_list(p, PIXELS[pixels])], names=[*names, "height", "width", "pixels"])

    kinds = dict(index.dtypes)
    return index.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in names), f"height int, width int, pixels array<{pixels}>"]))


def read_large_stacks(spark: SparkSession, path: str, planes_per_task: int = 16, pixels: str = "double") -> DataFrame:
    """path, frame, height, width, pixels of the files that `path`, a folder, a file or a glob that tasks can open, names;
    tasks read about planes_per_task planes each (judged by the files' sizes and their first plane)."""
    spark.dataSource.register(TiffStacks)
    return spark.read.format("tiff_stack").option("planes_per_task", planes_per_task).option("pixels", pixels).load(path)


@dataclass
class _Planes(InputPartition):
    """The planes of one of `parts` equal parts of a file."""

    path: str
    part: int
    parts: int


class _TiffReader(DataSourceReader):
    def __init__(self, path: str, planes_per_task: int, pixels: str):
        self.path, self.planes_per_task, self.pixels = path, planes_per_task, pixels

    def partitions(self) -> list[_Planes]:
        """Names and sizes are all that is looked at here, and each file's first plane's fields."""
        found = []
        for path, size in listed(self.path, (".tif", ".tiff")):
            with opened(path) as f, _naming(path):
                chain = directories(_from(f))
                first, second = next(chain, None), next(chain, None)
            about = 1 if second is None else max(1, size // max(1, abs(second - first)))
            parts = -(-about // self.planes_per_task)
            found += [_Planes(path, k, parts) for k in range(parts)]
        return found

    def read(self, partition: _Planes) -> Iterator[pa.RecordBatch]:
        with opened(partition.path) as f, _naming(partition.path):
            read = _from(f)
            order, large, _ = _header(read)
            offsets = list(directories(read))
            begin, end = (len(offsets) * k // partition.parts for k in (partition.part, partition.part + 1))
            for frame in range(begin, end):
                p = plane(read, offsets[frame], order, large)
                row = [pa.array([partition.path]), *(pa.array([n], pa.int32()) for n in (frame, *p.shape)), as_list(p, PIXELS[self.pixels])]
                yield pa.RecordBatch.from_arrays(row, names=["path", "frame", "height", "width", "pixels"])


def _from(f) -> Read:
    def read(at: int, n: int) -> bytes:
        f.seek(at)
        return f.read(n)

    return read


class TiffStacks(DataSource):
    """spark.read.format("tiff_stack").load(path), and df.write.format("tiff_stack").mode("append").save(folder) of rows
    (file, frame, height, width, pixels) with all rows of a file in one partition (see `write_stacks`). Folders must be
    ones that tasks can open (`files.opened`). Options: pixels, Spark's type of the pixels read; dtype, the numpy type of
    those written."""

    @classmethod
    def name(cls) -> str:
        return "tiff_stack"

    def schema(self) -> str:
        return PLANES.replace("array<double>", f"array<{self.options.get('pixels', 'double')}>")

    def reader(self, schema) -> DataSourceReader:
        return _TiffReader(self.options["path"], int(self.options.get("planes_per_task", 16)), self.options.get("pixels", "double"))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _TiffWriter(self.options["path"], self.options.get("dtype", "float32"))


class _TiffWriter(FolderWriter):
    def __init__(self, folder: str, dtype: str):
        super().__init__(folder)
        self.dtype = dtype

    def write(self, iterator) -> WriterCommitMessage:
        stacks: dict[str, list] = {}
        done = []
        for row in iterator:
            if row["file"] not in stacks:
                done += [self.save(f, self._content(p)) for f, p in stacks.items()]
                stacks = {row["file"]: []}
            stacks[row["file"]].append((row["frame"], np.array(row["pixels"], self.dtype).reshape(row["height"], row["width"])))
        return self.message(done + [self.save(f, self._content(p)) for f, p in stacks.items()])

    @staticmethod
    def _content(planes: list) -> bytes:
        return encode([p for _, p in sorted(planes, key=lambda x: x[0] or 0)])


def write_stacks(planes: DataFrame, folder: str, dtype: str = "float32") -> None:
    """A file per value of `file`, its planes in order of frame."""
    planes.sparkSession.dataSource.register(TiffStacks)
    dealt = planes.select(
        "file", F.col("frame").cast("int").alias("frame"), F.col("height").cast("int").alias("height"),
        F.col("width").cast("int").alias("width"), F.col("pixels").cast("array<double>").alias("pixels"),
    )
    dealt.repartition("file").sortWithinPartitions("file", "frame").write.format("tiff_stack").mode("append").option("dtype", dtype).save(folder)
