import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from slidemill import cli
from slidemill.functions.scalars import valid_tiff
from slidemill.images import mask as M
from slidemill.images import png, tiff, work
from slidemill.images.paths import crop_path, mask_path
from slidemill.sources.files import read_images
from slidemill.streaming.incremental import new_files, pending, run_available
from tests.conftest import rows


def slide():
    pixels = np.full((400, 400, 3), 255, np.uint8)
    pixels[100:300, 120:320] = (120, 80, 40)
    return pixels


@pytest.mark.parametrize("deflate", [False, True])
@pytest.mark.parametrize("pixels", [slide(), np.arange(1200, dtype=np.uint8).reshape(30, 40)])
def test_tiff_round_trip(pixels, deflate):
    data = tiff.encode(pixels, deflate)
    assert (tiff.decode(data) == pixels).all()
    assert tiff.describe(data)[0] and not tiff.describe(data[: len(data) // 2])[0] and not tiff.describe(b"II*\0" + b"\0" * 2000)[0]


@pytest.mark.parametrize("pixels", [slide()[90:150, 100:160], np.arange(1200, dtype=np.uint8).reshape(30, 40)])
def test_png(pixels):
    data = png.encode(pixels)
    assert (png.decode(data) == pixels).all()
    for bad in (b"", data[:40], data[:-30], b"x" * 100):
        with pytest.raises(ValueError):
            png.decode(bad)


def test_png_filters():
    rng = np.random.default_rng(2)
    pixels = rng.integers(0, 255, (5, 7, 3)).astype(np.uint8)
    flat, lines = pixels.reshape(5, -1).astype(int), []
    for y, kind in enumerate((1, 2, 3, 4, 0)):
        up = flat[y - 1] if y else np.zeros(21, int)
        left, corner = np.roll(flat[y], 3), np.roll(up, 3)
        left[:3] = corner[:3] = 0
        paeth = [min((a, b, c), key=lambda v: abs(a + b - c - v)) for a, b, c in zip(left, up, corner)]
        guess = {0: 0 * up, 1: left, 2: up, 3: (left + up) // 2, 4: np.array(paeth)}[kind]
        lines.append(np.concatenate([[kind], (flat[y] - guess) % 256]))
    raw = np.array(lines, np.uint8).tobytes()
    head = png.struct.pack(">IIBBBBB", 7, 5, 8, 2, 0, 0, 0)
    data = png.SIGNATURE + png._chunk(b"IHDR", head) + png._chunk(b"IDAT", png.zlib.compress(raw)) + png._chunk(b"IEND", b"")
    assert (png.decode(data) == pixels).all()


def brute_dilate(mask, size):
    out, r = np.zeros_like(mask), size // 2
    for y, x in np.argwhere(mask):
        for dy, w in zip(range(-r, r + 1), M.half_widths(size)):
            if 0 <= y + dy < len(mask):
                out[y + dy, max(0, x - w) : x + w + 1] = True
    return out


def test_kernels_against_brute_force():
    rng = np.random.default_rng(1)
    mask = rng.random((40, 50)) < 0.05
    for size in (3, 7, 51):
        assert (M.dilate(mask, size) == brute_dilate(mask, size)).all()
    assert (M.close(mask, 7) >= mask).all()
    image = rng.integers(0, 255, (40, 60)).astype(float)
    assert np.allclose(M.area_resize(image, 0.2), image.reshape(8, 5, 12, 5).mean(axis=(1, 3)))
    ring = np.zeros((20, 20), bool)
    ring[5:15, 5:15] = True
    ring[8:12, 8:12] = False
    assert M.fill_holes(ring).sum() == 100
    assert M.drop_small(ring, 85).sum() == 0 and M.drop_small(ring, 84).sum() == 84
    corner = np.zeros((20, 20), bool)
    corner[2:12, 2:4] = corner[10:12, 2:12] = True
    hull = M.fill_hulls(corner)
    assert hull.sum() > corner.sum() and not hull[2, 11] and hull[9, 4]
    diagonal = np.eye(6, dtype=bool)
    assert len(set(M.components(diagonal)[1])) == 1


def test_mask_geometry():
    box = M.bounding_box(M.tissue_mask(slide()) > 0)
    assert all(abs(a - b) <= 6 for a, b in zip(box, (100, 120, 299, 319)))
    assert M.tissue_mask(np.full((400, 400, 3), 255, np.uint8)).sum() == 0
    assert M.crop(slide(), np.zeros((400, 400))) is None


def test_mask_and_crop_tasks(spark, tmp_path):
    paths = [tmp_path / n for n in ("a.tif", "blank.tif", "corrupt.tif", "redo.tif")]
    for p, data in zip(paths, (tiff.encode(slide()), tiff.encode(np.full((300, 300, 3), 255, np.uint8)), b"x" * 3000, tiff.encode(slide()))):
        p.write_bytes(data)
    (tmp_path / "masks").mkdir()
    (tmp_path / "masks/redo_mask.npy").write_bytes(b"")
    df = spark.createDataFrame([(str(p),) for p in paths], "path string").withColumn("target", mask_path(F.col("path")))
    status = {r.path.rsplit("/", 1)[1]: r.status for r in work.make_masks(df).collect()}
    assert status == {"a.tif": "ok", "blank.tif": "no_tissue", "corrupt.tif": "failed", "redo.tif": "ok"}
    again = {r.path.rsplit("/", 1)[1]: r.status for r in work.make_masks(df).collect()}
    assert again == {"a.tif": "skipped", "blank.tif": "skipped", "corrupt.tif": "failed", "redo.tif": "skipped"}
    crops = df.withColumn("target", crop_path(F.col("path")))
    root = str(tmp_path)
    done = {r.path.rsplit("/", 1)[1]: r.status for r in work.make_crops(crops, lambda p: f"{root}/masks/{p.rsplit('/', 1)[1][:-4]}_mask.npy").collect()}
    assert done == {"a.tif": "ok", "blank.tif": "no_tissue", "corrupt.tif": "missing_mask", "redo.tif": "ok"}
    assert np.load(tmp_path / "crops/a_crop.npy").shape[0] < 230
    assert {r.status for r in work.verify(df, delete_corrupt=True).collect()} == {"ok", "corrupt"}
    assert not paths[2].exists()


def test_download_falls_back_without_repeating_4xx(spark, tmp_path):
    log = tmp_path / "log"
    good = b"II*\0" + b"\0" * 2000

    def fetch(url, timeout):
        with open(log, "a") as f:
            f.write(url + "\n")
        return {"idr": (404, "", b"", None), "hpa": (200, "image/tiff", good, len(good)), "web": (200, "text/html", good, None), "cut": (200, "image/tiff", good, 9999)}[url]

    urls = "array<struct<source: string, url: string>>"
    data = [("a", str(tmp_path / "d/a.tif"), [("idr", "idr"), ("hpa", "hpa")]), ("b", str(tmp_path / "b.tif"), [("hpa", "web")]), ("c", str(tmp_path / "c.tif"), []), ("d", str(tmp_path / "e.tif"), [("hpa", "cut")])]
    df = spark.createDataFrame(data, f"image_id string, target string, urls {urls}").coalesce(1)
    got = {r.image_id: (r.status, r.source, r.message) for r in work.download(df, fetch=fetch, retries=1).collect()}
    assert got["a"] == ("ok", "hpa", "idr: HTTP 404") and got["b"][0] == "failed" and got["c"] == ("failed", "", "no url")
    assert "of 9999 bytes" in got["d"][2]
    assert log.read_text().split() == ["idr", "hpa", "web", "web", "cut", "cut"]
    assert {r.status for r in work.download(df.where("image_id = 'a'"), fetch=fetch).collect()} == {"skipped"}


def test_new_files_are_processed_once(spark, tmp_path):
    folder, results, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    for step, names in enumerate((["a.tif", "b.tif"], ["c.tif"])):
        for n in names:
            (tmp_path / "in" / n).write_bytes(b"x" * 10)
        run_available(new_files(spark, folder), lambda batch: batch.withColumn("step", F.lit(step)), results, checkpoint).awaitTermination()
    out = spark.read.parquet(results)
    assert sorted((r.path.rsplit("/", 1)[1], r.step) for r in out.collect()) == [("a.tif", 0), ("b.tif", 0), ("c.tif", 1)]
    assert rows(pending(spark.createDataFrame([("x",), ("y",)], "path string"), spark.createDataFrame([("x",)], "path string"))) == [("y",)]


def test_commands(spark, tmp_path):
    root = tmp_path / "root"
    (root / "b/4").mkdir(parents=True)
    (root / "b/4/i1.tif").write_bytes(tiff.encode(slide()))
    (root / "b/4/i2.tif").write_bytes(b"short")
    csv = tmp_path / "d.csv"
    csv.write_text("image_id,local_path,idr_url,hpa_url,set\ni1,b/4,,,train\ni2,b/4,,,val\ni3,b/4,,,val\n")
    where = ["--csv-file", str(csv), "--img-root", str(root), "--num-workers", "2"]
    assert cli.main(["masks", *where, "--report-dir", str(tmp_path)], spark) == 1  # i2 is damaged
    assert (root / "b/4/masks/i1_mask.npy").exists() and not (root / "b/4/masks/i2_mask.npy").exists()
    assert cli.main(["crops", *where, "--max-images", "1"], spark) == 0
    assert cli.main(["crops", "--root", str(root), "--save-format", "tif", "--padding", "20"], spark) == 1
    assert tiff.decode((root / "b/4/crops/i1_crop.tif").read_bytes()).shape == (240, 240, 3)
    assert cli.main(["masks", *where, "--output-format", "png", "--max-images", "1"], spark) == 0
    assert cli.main(["crops", *where, "--mask-format", "png", "--save-format", "png", "--max-images", "1"], spark) == 0
    assert png.decode((root / "b/4/crops/i1_crop.png").read_bytes()).shape == (210, 210, 3)
    assert cli.main(["download", "--csv", str(csv), "--root", str(root), "--verify", "--set", "train"], spark) == 0
    assert cli.main(["download", "--csv", str(csv), "--root", str(root), "--retries", "0"], spark) == 1  # no urls
    files = read_images(spark, str(root), "i*.tif")
    valid = {r.path.rsplit("/", 1)[1]: r.v for r in files.select("path", valid_tiff(F.col("content"), F.col("length")).alias("v")).collect()}
    assert valid["i1.tif"] and not valid["i2.tif"]


def pack_lzw(data):
    """Plain LZW with codes as the format has them: widened one code early, cleared when the table is full."""
    bits, width, table, seen = [], 9, {}, b""

    def put(code):
        bits.append(format(code, f"0{width}b"))

    put(256)
    for k in range(len(data)):
        c = data[k : k + 1]
        if len(seen + c) == 1 or seen + c in table:
            seen += c
            continue
        put(table[seen] if len(seen) > 1 else seen[0])
        table[seen + c] = 258 + len(table)
        if 258 + len(table) >= 1 << width and width < 12:
            width += 1
        if len(table) >= 4096 - 258 - 2:
            put(256)
            table, width = {}, 9
        seen = c
    if seen:
        put(table[seen] if len(seen) > 1 else seen[0])
    if 259 + len(table) >= 1 << width and width < 12:
        width += 1
    put(257)
    text = "".join(bits)
    return int(text.ljust(-(-len(text) // 8) * 8, "0"), 2).to_bytes(-(-len(text) // 8), "big")


@pytest.mark.parametrize("n", [0, 1, 5, 600, 40_000])
def test_lzw_round_trip(n):
    rng = np.random.default_rng(n)
    for data in (rng.integers(0, 4, n, np.uint8).tobytes(), rng.integers(0, 256, n, np.uint8).tobytes(), b"a" * n):
        assert tiff.unpack_lzw(pack_lzw(data)) == data


def test_lzw_codes():
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]
    text = "".join(format(c, "09b") for c in codes).ljust(88, "0")
    assert tiff.unpack_lzw(int(text, 2).to_bytes(11, "big")) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    with pytest.raises(ValueError):
        tiff.unpack_lzw(int("".join(format(c, "09b") for c in (256, 7, 300)).ljust(32, "0"), 2).to_bytes(4, "big"))


@pytest.mark.parametrize("predictor", [1, 2])
def test_lzw_image(predictor):
    pixels = np.random.default_rng(3).integers(0, 256, (20, 30, 3), np.uint8)
    stored = pixels if predictor == 1 else np.diff(pixels, axis=1, prepend=np.zeros((20, 1, 3), np.uint8))
    strips = [pack_lzw(stored[a : a + 8].tobytes()) for a in (0, 8, 16)]
    starts = np.cumsum([8, *map(len, strips)])
    tags = [(256, [30]), (257, [20]), (258, [8, 8, 8]), (259, [5]), (262, [2]), (273, starts[:3].tolist()), (277, [3]), (278, [8]), (279, list(map(len, strips))), (317, [predictor])]
    extra, at = b"", int(starts[3]) + 2 + 12 * len(tags) + 4
    entries = b""
    for tag, values in tags:
        body = struct.pack(f"<{len(values)}I", *values)
        where = body if len(values) == 1 else struct.pack("<I", at + len(extra))
        extra += b"" if len(values) == 1 else body
        entries += struct.pack("<HHI", tag, 4, len(values)) + where
    data = b"II*\0" + struct.pack("<I", int(starts[3])) + b"".join(strips) + struct.pack("<H", len(tags)) + entries + b"\0" * 4 + extra
    assert (tiff.decode(data) == pixels).all()
