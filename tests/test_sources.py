"""TIFF and workbook round trips, discovery by names, the streaming linker, and a movie from files to its summary."""

from __future__ import annotations

import io
import os
import struct
import time
import tracemalloc
import zipfile
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.plans import joined_rows
from trackloom import params, schemas
from trackloom.functions.linker import Options
from trackloom.operators import images, linking, measure, regions
from trackloom.plans import catalogue, experiment, folder, stacks
from trackloom.sources import discovery, files, sheets, tiff
from trackloom.streaming import linker


@pytest.mark.parametrize("kind", ["uint8", "int16", "uint16", "int32", "float16", "float32", "float64"])
@pytest.mark.parametrize("compress", [True, False])
def test_tiff_round_trip(kind, compress):
    stack = [(np.arange(12).reshape(3, 4) * 7 + i).astype(kind) for i in range(3)]
    back = list(tiff.decode(tiff.encode(stack, compress)))
    assert len(back) == 3 and all((a == b).all() and b.dtype.kind == a.dtype.kind for a, b in zip(stack, back))


def test_tiff_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        list(tiff.decode(b"GIF89a.."))
    (tmp_path / "x.tif").write_bytes(b"II*\0")
    with pytest.raises(Exception, match="x.tif"):
        tiff.read_stacks(spark, str(tmp_path)).collect()


def packbits(raw):
    return b"".join(bytes([min(128, len(raw) - i) - 1]) + raw[i : i + 128] for i in range(0, len(raw), 128))


def lzw(raw):
    """Codes as they are written: a table that starts anew before it is full."""
    out, n_bits, table, size = 0, 0, {bytes([i]): i for i in range(256)}, 9

    def put(code):
        nonlocal out, n_bits
        out, n_bits = out << size | code, n_bits + size

    put(256)
    word = b""
    for i in range(len(raw)):
        longer = word + raw[i : i + 1]
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer] = len(table) + 2
        if len(table) + 2 >= 4094:
            put(256)
            table, size = {bytes([k]): k for k in range(256)}, 9
        else:
            size = max(9, (len(table) + 2).bit_length())
        word = raw[i : i + 1]
    put(table[word])
    size = min(12, max(9, (len(table) + 3).bit_length()))
    put(257)
    return (out << -n_bits % 8).to_bytes(-(-n_bits // 8), "big")


def rewritten(plane, compression=1, predictor=1, tile=None, large=False):
    """A one-plane file in another coding than the library writes."""
    h, w = plane.shape
    th, tw = tile or (h, w)
    blocks = []
    for top in range(0, h, th):
        for left in range(0, w, tw):
            block = np.zeros((th, tw), plane.dtype)
            part = plane[top : top + th, left : left + tw]
            block[: part.shape[0], : part.shape[1]] = part
            if predictor == 2:
                block = np.diff(block, axis=1, prepend=np.zeros((th, 1), plane.dtype))
            blocks.append({1: bytes, 5: lzw, 32773: packbits}[compression](block.astype(plane.dtype).tobytes()))
    head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, 0) if large else b"II*\0" + bytes(4)
    at = [len(head) + sum(map(len, blocks[:k])) for k in range(len(blocks) + 1)]
    tags = [(256, [w]), (257, [h]), (258, [plane.dtype.itemsize * 8]), (259, [compression]), (277, [1]), (317, [predictor]), (339, [1])]
    tags += [
        (322, [tw]), (323, [th]), (324, at[:-1]), (325, [len(b) for b in blocks]),
    ] if tile else [(273, at[:-1]), (278, [h]), (279, [len(b) for b in blocks])]
    kind, one, many, inline = (16, "Q", "<HHQ", 8) if large else (4, "I", "<HHI", 4)
    extra, entries = b"", b""
    for tag, values in sorted(tags):
        raw = struct.pack(f"<{len(values)}{one}", *values)
        if len(raw) > inline:
            raw, extra = struct.pack("<" + one, at[-1] + len(extra)), extra + raw
        entries += struct.pack(many, tag, kind, len(values)) + raw
    start = struct.pack("<" + one, at[-1] + len(extra))
    head = head[:8] + start if large else head[:4] + start
    return head + b"".join(blocks) + extra + struct.pack("<Q" if large else "<H", len(tags)) + entries + struct.pack("<" + one, 0)


@pytest.mark.parametrize(
    "how",
    [
        {}, {"compression": 5}, {"compression": 32773}, {"predictor": 2}, {"compression": 5, "predictor": 2}, {"tile": (16, 32)},
        {"tile": (16, 16), "compression": 5}, {"large": True}, {"large": True, "tile": (32, 16)},
    ],
)
@pytest.mark.parametrize("kind", ["uint8", "uint16"])
def test_tiff_codings(how, kind):
    for plane in (np.arange(40 * 50).reshape(40, 50) // 7 % 200, np.random.default_rng(0).integers(0, 200, (120, 90)), np.zeros((30, 30), int)):
        (back,) = tiff.decode(rewritten(plane.astype(kind), **how))
        assert back.dtype == kind and (back == plane).all()


def test_large_stacks(spark, tmp_path):
    stacks = {f"s{k}.tif": [(np.arange(12).reshape(3, 4) * 7 + i + k).astype("uint16") for i in range(5)] for k in range(2)}
    for name, stack in stacks.items():
        (tmp_path / name).write_bytes(tiff.encode(stack, compress=name == "s0.tif"))
    (tmp_path / "notes.txt").write_text("x")
    table = tiff.read_large_stacks(spark, str(tmp_path), planes_per_task=2)
    assert table.rdd.getNumPartitions() == 6
    got = {(os.path.basename(r.path), r.frame): np.array(r.pixels).reshape(r.height, r.width) for r in table.collect()}
    assert len(got) == 10 and all((got[name, i] == p).all() for name, stack in stacks.items() for i, p in enumerate(stack))
    circle = bytearray(tiff.encode(stacks["s0.tif"][:1]))
    circle[-4:] = circle[4:8]
    with pytest.raises(ValueError, match="circle"):
        list(tiff.decode(bytes(circle)))


def test_workbook(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 2, None, None), ("a", 1, "a & <b>", 2.5), ("b", 3, "x", float("nan"))],
        "movie string, particle long, `Area std.` string, mitosis double",
    )
    name = F.concat(F.lit("exp_A01_s1_inference/"), F.col("movie"), F.lit("_A01_s1_summary.xlsx")).alias("file")
    notes = params.key_values(spark, params.CellParams()).select(F.lit("exp_A01_s1_inference/a_A01_s1_summary.xlsx").alias("file"), "*")
    sheets.write_workbooks(
        str(tmp_path), {"Summary": df.select(name, "particle", "`Area std.`", "mitosis"), "parameters": notes},
        {"Summary": ["particle"]},
    )
    folder = tmp_path / "exp_A01_s1_inference"
    assert sorted(os.listdir(folder)) == ["a_A01_s1_summary.xlsx", "b_A01_s1_summary.xlsx"]
    content = (folder / "a_A01_s1_summary.xlsx").read_bytes()
    assert sheets.rows_of(content) == [
        {"particle": 1.0, "Area std.": "a & <b>", "mitosis": 2.5}, {"particle": 2.0, "Area std.": None, "mitosis": None},
    ]
    assert {"name": "memory", "value": "1"} in sheets.rows_of(content, "parameters") and sheets.rows_of(
        (folder / "b_A01_s1_summary.xlsx").read_bytes(), "parameters",
    ) == []
    got = sheets.read_workbooks(spark, str(tmp_path), "particle long, mitosis double, GFP double").orderBy("particle").collect()
    assert [tuple(r) for r in got] == [("exp_A01_s1_inference", f"{m}_A01_s1_summary.xlsx", n, v, None) for m, n, v in (("a", 1, 2.5), ("a", 2, None), ("b", 3, None))]


def test_typed_cells(spark, tmp_path):
    """Booleans, dates of built-in and own formats, shared texts, errors and cells without names, as other programs write them."""
    book = sheets.Workbook([("s", ["flag", "day", "time", "text", "number", "error"])])
    book.add(0, [True, None, None, None, 1.5, None])
    rows = '<row><c t="b"><v>0</v></c><c s="1"><v>45000</v></c><c s="2"><v>1.5</v></c><c t="s"><v>1</v></c><c s="3"><v>7</v></c><c t="e"><v>#N/A</v></c></row>'
    styles = f'<styleSheet xmlns="{sheets.MAIN}"><numFmts><numFmt numFmtId="164" formatCode="hh:mm"/><numFmt numFmtId="165" formatCode="0.0&quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>'
    shared = f'<sst xmlns="{sheets.MAIN}"><si><t>no</t></si><si><r><t>ye</t></r><r><t>s</t></r></si></sst>'
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(book.content())) as z, zipfile.ZipFile(out, "w") as new:
        for name in z.namelist():
            new.writestr(name, z.read(name).replace(b"</sheetData>", rows.encode() + b"</sheetData>"))
        new.writestr("xl/styles.xml", styles)
        new.writestr("xl/sharedStrings.xml", shared)
    first, second = sheets.rows_of(out.getvalue())
    assert first == {"flag": True, "day": None, "time": None, "text": None, "number": 1.5, "error": None}
    assert second == {"flag": False, "day": datetime(2023, 3, 15), "time": datetime(1899, 12, 31, 12), "text": "yes", "number": 7.0, "error": "#N/A"}
    (tmp_path / "x_summary.xlsx").write_bytes(out.getvalue())
    got = sheets.read_workbooks(spark, str(tmp_path), "flag boolean, day date, time timestamp_ntz, text string, number int, error double, more double").collect()
    assert [tuple(r)[2:] for r in got] == [(True, None, None, None, 1, None, None), (False, datetime(2023, 3, 15).date(), datetime(1899, 12, 31, 12), "yes", 7, None, None)]


def test_a_sheet_is_read_as_a_stream():
    book = sheets.Workbook([("s", [f"c{i}" for i in range(12)])])
    for i in range(60_000):
        book.add(0, [i + k / 7 for k in range(12)])
    content = book.content()
    tracemalloc.start()
    n = sum(1 for row in sheets.stream_rows(content) if row["c11"] is not None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 60_000 and peak < 8 << 20


def test_workbook_has_a_limit(monkeypatch):
    monkeypatch.setattr(sheets, "MAX_ROWS", 2)
    book = sheets.Workbook([("s", ["a"])])
    book.add(0, [1])
    book.add(0, [2])
    with pytest.raises(ValueError, match="more than 2 rows"):
        book.add(0, [3])


def test_discovery(spark, tmp_path):
    for f in (
        "exp_A02_s1_inference/exp_A02_s1_instance.tif", "exp_A02_s1_inference/exp_A02_s1_semantic.tif", "exp_A02_s1_GFP.tif",
        "exp_A02_s1_GFP.tiff", "exp_A02_s1_phs.tif", "Texas Red_background_map.tif", "GFP_intensity.tif", "notes.txt",
        "exp_B03_s2_inference/exp_B03_s2_instance.tif", "exp_A02_s12_Cy5.tif", "other/exp_A02_s1_Cy5.tif",
    ):
        os.makedirs((tmp_path / f).parent, exist_ok=True)
        (tmp_path / f).write_bytes(b"x")  # empty files have no rows
    found = discovery.files(spark, str(tmp_path))
    assert {r.folder for r in discovery.inference_folders(found).collect()} == {"exp_A02_s1_inference", "exp_B03_s2_inference"}
    movies = discovery.movies(found)
    (movie,) = movies.collect()
    assert (movie.stub, movie.prefix) == ("A02_s1", "exp_") and movie.instance.endswith("instance.tif") and movie.movie_id == f"{movie.home}/exp_A02_s1"
    assert {(r.channel, r.path.rsplit("/", 1)[1]) for r in discovery.channels(found, movies).collect()} == {("GFP", "exp_A02_s1_GFP.tiff"), ("phase", "exp_A02_s1_phs.tif")}
    assert {r.correction_map for r in discovery.correction_maps(found).collect()} == {"Texas Red_background_map", "GFP_intensity_map"}


def sorted_after_hashing(df):
    """Whether all that a plan's aggregations sort before they shuffle comes out of a hash aggregation."""
    lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
    sorts = [i for i, line in enumerate(lines) if "SortAggregate" in line and "partial_" in line]
    inputs = [next(x for x in lines[i + 1 :] if not any(p in x for p in ("Project", "Filter", "Generate"))) for i in sorts]
    return bool(sorts) and all("HashAggregate" in x for x in inputs)


@pytest.mark.parametrize("name", ["movie_files", "parameter_sheet", "map_files"])
def test_repeated_names_are_hashed_before_sorts(spark, name):
    """A name that lies in many rows is one row before a task sorts."""
    assert sorted_after_hashing(catalogue.QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_images_are_reduced_before_they_meet_movies(spark):
    """500 images of one site and channel, and one movie there: the join has a row for each channel."""
    masks = [("/d/A02_s1_inference", f"A02_s1_{role}.tif") for role in ("instance", "semantic")]
    images = [("/d", f"{i:03}_A02_s1_GFP.tif") for i in range(500)] + [("/d", "499_A02_s1_Cy5.tif"), ("/d", "000_A02_s1_Cy5.tiff")]
    rows = [(f"{home}/{file}", home, file) for home, file in masks + images]
    found = discovery.classified(spark.createDataFrame(rows, "path string, home string, file string"))
    channels = discovery.channels(found, discovery.movies(found))
    assert {(r.channel, r.path) for r in channels.collect()} == {("GFP", "/d/499_A02_s1_GFP.tif"), ("Cy5", "/d/000_A02_s1_Cy5.tiff")}
    assert joined_rows(channels) == [2]


def cells(n=12, size=50, shift=0, mitotic=range(3, 8)):
    """Planes of one cell that moves down, and its states."""
    labels, states = np.zeros((n, size, size), np.int32), np.zeros((n, size, size), np.uint8)
    for f in range(n):
        labels[f, 4 + f : 22 + f, 4 + shift : 22 + shift] = 1
        states[f, 4 + f : 22 + f, 4 + shift : 22 + shift] = 101 if f in mitotic else 1
    return labels, states


def put(folder, name, labels, states, **channels):
    """A movie's files: masks in an inference folder, images beside it."""
    home = folder / f"{name}_inference"
    home.mkdir(parents=True)
    (home / f"{name}_instance.tif").write_bytes(tiff.encode(list(labels)))
    (home / f"{name}_semantic.tif").write_bytes(tiff.encode(list(states)))
    for channel, stack in channels.items():
        (folder / f"{name}_{channel}.tif").write_bytes(tiff.encode(list(stack)))


def flat(labels, value):
    return np.full((len(labels), 2 * labels.shape[1], 2 * labels.shape[2]), value, np.float32)


@pytest.mark.parametrize("read", [None, tiff.read_stacks])
def test_equal_names_in_two_experiments(spark, tmp_path, read):
    """Each movie is measured on the images of its own experiment, and of its own site."""
    for e, value, shift in (("e1", 100.0, 0), ("e2", 200.0, 5)):
        labels, states = cells(shift=shift)
        put(tmp_path / e, "exp_A2_s1", labels, states, GFP=flat(labels, value))
        (tmp_path / e / "exp_A2_s12_GFP.tif").write_bytes(tiff.encode(list(flat(labels, 7.0))))
    (tmp_path / "e2" / "exp_A2_s12_Cy5.tif").write_bytes(tiff.encode(list(flat(labels, 9.0))))
    run = folder.analyse(spark, str(tmp_path), read=read)
    assert sorted(r.movie_id.split("/")[-3:] for r in run.movies.collect()) == [[e, "exp_A2_s1_inference", "exp_A2_s1"] for e in ("e1", "e2")]
    assert "Cy5" not in run.tracks.columns
    rows = run.tracks.collect()
    assert len(rows) == 24 and all(r["GFP"] == (100.0 if "/e1/" in r.movie_id else 200.0) and r.y == (12 if "/e1/" in r.movie_id else 17) for r in rows)
    run.save(str(tmp_path))
    assert sorted(os.path.relpath(os.path.join(d, f), tmp_path) for d, _, names in os.walk(tmp_path) for f in names if f.endswith("xlsx")) == [f"{e}/exp_A2_s1_inference/exp_A2_s1_{k}.xlsx" for e in ("e1", "e2") for k in ("analysis", "summary", "tracks")]


def test_only_needed_planes_are_read(spark, tmp_path):
    """Pixels of frames without a mitotic track are broken, and only rows of paths and offsets are shuffled."""
    labels, states = cells(14)
    other = np.zeros_like(labels)
    put(tmp_path, "m_A01_s1", np.concatenate([labels, other]), np.concatenate([states, other.astype(np.uint8)]), GFP=np.concatenate([flat(labels, 5.0)] * 2))
    path = tmp_path / "m_A01_s1_GFP.tif"
    content = bytearray(path.read_bytes())
    read = lambda at, n: bytes(content[at : at + n])
    for at in list(tiff.directories(read))[14:]:
        offset, size = (tiff._fields(read, at, "<", False)[t][0] for t in (tiff.OFFSETS, tiff.COUNTS))
        content[offset : offset + size] = bytes(size)
    path.write_bytes(content)
    run = folder.analyse(spark, str(tmp_path))
    assert [r["GFP"] for r in run.tracks.collect()] == [5.0] * 14
    with pytest.raises(Exception, match="m_A01_s1_GFP.tif"):
        tiff.read_stacks(spark, str(path)).collect()
    p = params.for_cell_type("hela")
    files = {n: stacks.index(spark.createDataFrame([("m", str(f))], "movie_id string, path string"), n) for n, f in (("labels", tmp_path / "m_A01_s1_inference/m_A01_s1_instance.tif"), ("channel", path))}
    wanted = spark.createDataFrame([("m", 3, 1)], "movie_id string, frame int, label int")
    found = stacks.signals(files["labels"], files["channel"], p, wanted)
    (row,) = found.collect()
    assert (row.frame, row.label, row.signal, row.bkg_corr, row.int_corr) == (3, 1, 5.0, 0.0, 1.0)
    assert "pixels" not in found._jdf.queryExecution().executedPlan().toString()


def test_paired_planes_equal_joined_planes(spark, tmp_path):
    r = np.random.default_rng(3)
    labels = r.integers(0, 4, (5, 30, 30)).astype(np.int32) * (r.random((5, 1, 1)) < 0.9)
    states = r.integers(0, 102, (4, 30, 30)).astype(np.uint8)  # one frame has no states
    channel, background = r.normal(50, 9, (5, 60, 60)).astype(np.float32), r.integers(0, 9, (5, 60, 60)).astype(np.int16)
    for name, stack in (("l", labels), ("s", states), ("c", channel), ("b", background), ("i", channel[:1] / 99)):
        (tmp_path / f"{name}.tif").write_bytes(tiff.encode(list(stack)))
    path = {n: str(tmp_path / f"{n}.tif") for n in "lscbi"}
    one = lambda n: spark.createDataFrame([("m", path[n])], "movie_id string, path string")
    planes = {n: tiff.read_planes(tiff.plane_index(one(n))) for n in "lscbi"}
    movies = spark.createDataFrame([("m", path["l"], path["s"])], "movie_id string, instance string, semantic string")
    rows = lambda df: sorted(tuple(repr(x[c]) for c in sorted(df.columns)) for x in df.collect())
    joined = regions.region_table(planes["l"]).join(regions.state_at_centre(regions.region_table(planes["l"]), planes["s"]).select("movie_id", "frame", "label", "semantic_raw"), ["movie_id", "frame", "label"], "left")
    got = stacks.regions_with_state(movies)
    assert rows(got) == rows(joined.select(got.columns)) and got.filter("semantic_raw is null").count() > 0
    p = params.for_cell_type("hela")
    wanted = spark.createDataFrame([("m", f) for f in range(5)], "movie_id string, frame int")
    at = tiff.plane_index(one("i")).first()
    background = tiff.plane_index(one("b").select("path")).select("frame", F.col("path").alias("background_path"), F.col("offset").alias("background_offset"))
    got = stacks.signals(stacks.index(one("l"), "labels"), stacks.index(one("c"), "channel"), p, wanted, background, (at["path"], at["offset"]))
    want = measure.signals(images.eroded(planes["l"], p.erosion_radius), planes["c"], planes["b"], planes["i"].drop("frame"))
    assert rows(got) == rows(want.select(got.columns)) and got.count() > 0


def test_tiles_of_a_plane_are_one_plane(spark):
    """Moments of tiles add up; far rows and columns cost no precision."""
    plane = np.random.default_rng(1).integers(0, 5, (40, 60))
    tile = lambda t, l: ("m", 0, t, l, 30, plane[t : t + 20, l : l + 30].reshape(-1).tolist())  # noqa: E731, E741
    tiles = spark.createDataFrame([tile(t, l) for t in (0, 20) for l in (0, 30)], "movie_id string, frame int, top int, left int, width int, pixels array<int>")
    whole = spark.createDataFrame([("m", 0, 60, plane.reshape(-1).tolist())], "movie_id string, frame int, width int, pixels array<int>")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(regions.region_table(tiles)) == rows(regions.region_table(whole)) and regions.region_table(whole).count() == 4
    far = regions.region_table(tiles.withColumn("top", F.col("top") + 3_000_000).withColumn("left", F.col("left") + 3_000_000))
    assert [r.eccentricity for r in far.orderBy("label").collect()] == [r.eccentricity for r in regions.region_table(whole).orderBy("label").collect()]


def test_filters_on_an_index(spark, tmp_path):
    """Planes that are filtered out aren't read; pixels come in the type asked for."""
    stack = [np.full((3, 4), i, np.uint16) for i in range(7)]
    (tmp_path / "a.tif").write_bytes(tiff.encode(stack))
    content = bytearray(tiff.encode(stack))
    read = lambda at, n: bytes(content[at : at + n])
    for at in list(tiff.directories(read))[3:]:
        content[tiff._fields(read, at, "<", False)[tiff.OFFSETS][0]] = 0  # no deflate data any more
    (tmp_path / "b.tif").write_bytes(content)
    index = tiff.plane_index(spark.createDataFrame([(k, str(tmp_path / f"{k}.tif")) for k in "ab"], "movie_id string, path string"))
    assert index.count() == 14
    table = tiff.read_planes(index.filter("frame < 3 or movie_id = 'a'"), "smallint")
    assert dict(table.dtypes)["pixels"] == "array<smallint>"
    assert sorted((r.movie_id, r.frame, r.pixels[0]) for r in table.collect()) == [("a", i, i) for i in range(7)] + [("b", i, i) for i in range(3)]
    with pytest.raises(Exception, match="b.tif"):
        tiff.read_planes(index).collect()
    assert dict(tiff.read_large_stacks(spark, str(tmp_path / "a.tif"), pixels="smallint").dtypes)["pixels"] == "array<smallint>"


def test_files_by_uri(tmp_path):
    """The writer goes through the store's interface; a task that fails leaves nothing, nor does a job."""
    root = f"file:{tmp_path}/deep"

    class Writer(files.FolderWriter):
        write = None

    writer = Writer(root)
    first, again = writer.save("a/x.bin", b"one"), writer.save("a/x.bin", b"two")
    assert not (tmp_path / "deep/a/x.bin").exists() and len(os.listdir(tmp_path / "deep/a")) == 2
    writer.commit([writer.message([again]), None])
    assert os.listdir(tmp_path / "deep/a") == ["x.bin"] and (tmp_path / "deep/a/x.bin").read_bytes() == b"two" and not os.path.exists(first[0].removeprefix("file:"))
    writer.abort([writer.message([writer.save("a/y.bin", b"y")]), None])
    with pytest.raises(TypeError):
        writer.save("a/z.bin", "no bytes")
    assert os.listdir(tmp_path / "deep/a") == ["x.bin"] and files.listed(root, (".bin",)) == [(f"{tmp_path}/deep/a/x.bin", 3)]
    with files.opened(f"{root}/a/x.bin") as f:
        f.seek(1)
        assert f.read(2) == b"wo"


def test_movie_from_files(spark, tmp_path):
    """Two cells of 18 x 18 pixels drift for 14 frames; one is mitotic in frames 4 to 8."""
    n, size = 14, 60
    labels, states = np.zeros((n, size, size), np.int32), np.ones((n, size, size), np.int32)
    for f in range(n):
        for cell, (r, c) in enumerate([(4 + f, 4), (30, 30 + f // 2)], 1):
            labels[f, r : r + 18, c : c + 18] = cell if f % 2 else 3 - cell  # ids change from frame to frame
            states[f, r : r + 18, c : c + 18] = 101 if cell == 1 and 4 <= f <= 8 else 1
    channel = np.repeat(np.repeat(labels * 10.0 + np.arange(n)[:, None, None], 2, 1), 2, 2)

    def rows(stack, name):
        return pd.DataFrame(
            {"file": name, "frame": range(n), "height": stack.shape[1], "width": stack.shape[2], "pixels": [[float(v) for v in p.reshape(-1)] for p in stack]}
        )

    for name, stack, kind in (
        ("m_A01_s1_instance.tif", labels, "int32"), ("m_A01_s1_semantic.tif", states, "uint8"),
        ("m_A01_s1_GFP.tif", channel, "float32"),
    ):
        tiff.write_stacks(spark.createDataFrame(rows(stack, name)), str(tmp_path), kind)
    assert sorted(os.listdir(tmp_path)) == ["m_A01_s1_GFP.tif", "m_A01_s1_instance.tif", "m_A01_s1_semantic.tif"]
    planes = tiff.read_stacks(spark, str(tmp_path)).withColumn("movie_id", F.lit("A01_s1")).cache()
    of = lambda name: planes.filter(F.col("path").endswith(name)).drop("path")
    p = params.for_cell_type("hela")
    tracks = experiment.track(of("instance.tif"), of("semantic.tif"), p).cache()
    assert tracks.count() == 2 * n and tracks.select("particle").distinct().count() == 2
    measured = experiment.measure_channel(tracks, of("instance.tif"), of("GFP.tif"), "GFP", p)
    (row,) = experiment.summary(measured, p).collect()
    assert (row.track_length, row.mito_start, row.mitosis, row.cell_area) == (n, 3, 5.0, 324.0)
    want = [(10.0 if f % 2 else 20.0) + f for f in range(4, 9)]
    assert row["GFP"] == pytest.approx(np.mean(want)) and row["GFP_std"] == pytest.approx(np.std(want)) and row["GFP_int_corr"] == 1.0
    assert experiment.display_frames(tracks).count() == 2 * n
    files = spark.createDataFrame([("A01_s1", "a.tif", "b.tif")], "movie_id string, instance string, semantic string")
    book = tmp_path / "m_A01_s1_inference"
    experiment.save_summary(measured, files, p, str(book))
    experiment.save_analysis(measured, files, p, str(book))
    experiment.save_tracks(tracks, str(book))
    assert sorted(os.listdir(book)) == ["A01_s1_analysis.xlsx", "A01_s1_summary.xlsx", "A01_s1_tracks.xlsx"]
    content = (book / "A01_s1_summary.xlsx").read_bytes()
    assert sheets.rows_of(content, "quality") == [{"Area std.": 0.0, "n_peaks": 0.0, "track number": 0.0}]
    assert sheets.rows_of(content, "file_data")[0] == {"name": "instance", "value": "a.tif"}
    back = sheets.read_workbooks(spark, str(book), schemas.SUMMARY + ", GFP double").first()
    assert (back.folder, back.mito_start, back.mitosis) == ("m_A01_s1_inference", 3, 5.0) and back.GFP == pytest.approx(row["GFP"])
    assert sheets.read_workbooks(spark, str(book), "particle long, GFP double", "*analysis.xlsx").count() == 2 * n


@pytest.mark.parametrize("read", [tiff.read_stacks, None, "large"])
def test_from_a_folder_to_an_experiment_table(spark, tmp_path, read):
    """Two movies with a channel and maps below a root folder -> workbooks beside the masks -> one labelled table."""
    n, size = 12, 50
    for well, shift in (("A01", 0), ("B02", 3)):
        labels, states = cells(n, size, shift)
        put(tmp_path, f"exp_{well}_s1", labels, states, GFP=flat(labels, 100.0 + shift))
    blank = [np.full((2 * size, 2 * size), 8 + i, np.uint16) for i in range(n)]
    (tmp_path / "blank_GFP.tif").write_bytes(tiff.encode(blank))
    p = params.for_cell_type("hela")
    made = folder.create_correction_maps(spark, {"intensity": str(tmp_path / "blank_GFP.tif"), "my background": str(tmp_path / "blank_GFP.tif")}, p)
    assert [os.path.basename(f) for f in made] == ["blank_GFP_intensity_map.tif", "blank_GFP_background_map.tif"] and all(map(os.path.exists, made))
    with pytest.raises(ValueError, match="neither"):
        folder.create_correction_maps(spark, {"other": "x.tif"}, p)

    large = lambda spark, path, pattern: tiff.read_large_stacks(spark, path).filter(F.col("path").rlike(".*" if pattern == "*" else pattern.strip("*").split("*")[0])).withColumn("path", F.concat(F.lit("file:"), "path"))
    run = folder.analyse(spark, str(tmp_path), read=large if read == "large" else read)
    assert {(r.movie_id.split("/")[-1], r.stub) for r in run.movies.collect()} == {("exp_A01_s1", "A01_s1"), ("exp_B02_s1", "B02_s1")}
    rows = run.tracks.collect()
    assert len(rows) == 2 * n and all(
        r["GFP"] == (103.0 if "B02" in r.movie_id else 100.0) and r["GFP_bkg_corr"] == 8.0 + r.frame and r["GFP_int_corr"] == pytest.approx(1.0) for r in rows
    )
    run.save(str(tmp_path))
    assert {f for _, _, names in os.walk(tmp_path) for f in names if f.endswith("xlsx")} == {f"exp_{w}_s1_{k}.xlsx" for w in ("A01", "B02") for k in ("tracks", "analysis", "summary")}
    wellmap = spark.createDataFrame(
        [(1, "HeLa", "t", "low", "A01"), (2, "HeLa", "t", "high", "B02, C03")],
        "nth long, celltype string, transfection string, drug string, well_ids string",
    )
    table = {r.code: r for r in folder.experiment_table(spark, str(tmp_path), wellmap, n, 10, "nth").collect()}
    assert set(table) == {"HeLa_t_low", "HeLa_t_high"}
    assert {(r.well, r.mito_start, r.mitosis, r["GFP"], r["Cy5"]) for r in table.values()} == {("A01", 2, 50.0, 100.0, None), ("B02", 2, 50.0, 103.0, None)}


@pytest.fixture
def state_store(spark):
    spark.conf.set(linker.STORE_CONF, f"org.apache.spark.sql.execution.streaming.state.{linker.STORE}")
    yield
    spark.conf.unset(linker.STORE_CONF)


def test_streaming_needs_its_store(spark):
    with pytest.raises(ValueError, match=linker.STORE):
        linker.link_stream(spark.range(1).selectExpr("id movie_id", "id frame", "id label", "id x", "id y"), Options(20))


@pytest.mark.parametrize("mode", ["vanilla", "predictive"])
def test_streaming_linker_equals_batch(spark, tmp_path, state_store, mode):
    """All frames leave, the last one too once nothing more comes; late rows say so; points may be missing for a frame."""
    r = np.random.default_rng(0)
    rows = [(m, f, i, float(100 * i + 3 * f + r.uniform(-5, 5)), float(m)) for m in range(3) for f in range(8) for i in range(4) if r.random() < 0.8 or f in (0, 7)]
    schema = "movie_id long, frame long, label long, x double, y double"
    batches = [rows[: len(rows) // 2], rows[len(rows) // 2 :], [(0, 2, 9, 1.0, 1.0)]]
    source = tmp_path / "in"
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(str(source))
        if i == 0:
            stream = spark.readStream.schema(schema).parquet(str(source))
            linked = linker.link_stream(stream, Options(20, mode=mode), idle_ms=15_000)
            query = linked.writeStream.format("memory").queryName(f"linked_{mode}").option("checkpointLocation", str(tmp_path / "state")).start()
        while query.lastProgress is None or query.recentProgress[-1].batchId < 0 or sum(p.numInputRows for p in query.recentProgress) < sum(map(len, batches[: i + 1])):
            assert query.isActive, query.exception()
            time.sleep(0.2)
    batch = {(x.movie_id, x.frame, x.label): x.particle for x in linking.link(spark.createDataFrame(rows, schema), Options(20, mode=mode)).collect()}
    out, until = spark.table(f"linked_{mode}"), time.time() + 120
    while (n := out.filter("link_error is null").count()) < len(rows) and time.time() < until:
        assert query.isActive, query.exception()
        time.sleep(0.5)
    query.stop()
    assert n == len(rows) and {(x.movie_id, x.frame, x.label): x.particle for x in out.filter("link_error is null").collect()} == batch
    assert [x.link_error for x in out.filter("link_error is not null").collect()] == ["late"]
