"""Image tasks on paths: download, verify, masks and crops, as Arrow tasks that may be repeated.

Tasks get paths and write beside them; every file appears by an atomic rename, and existing
results are skipped, so retries and speculative copies do no harm.
"""

from __future__ import annotations

import io
import os
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.functions.scalars import TIFF_LEAST_BYTES, TIFF_MAGIC
from slidemill.images import mask as masks
from slidemill.images import png, tiff
from slidemill.sources import store

#: ``(url, timeout) -> (status code, content type, body, announced length or None)``
Fetcher = Callable[[str, float], tuple[int, str, bytes, int | None]]
STATUS = "path string, status string, message string"
DOWNLOAD = "image_id string, status string, source string, message string"


def http_fetch(url: str, timeout: float) -> tuple[int, str, bytes, int | None]:
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:
            size = r.headers.get("Content-Length")
            return r.status, r.headers.get("Content-Type", ""), r.read(), int(size) if size else None
    except urllib.error.HTTPError as e:
        return e.code, "", b"", None


def valid_file(path: str) -> bool:
    try:
        return (store.size(path) or 0) >= TIFF_LEAST_BYTES and store.read(path, 4) in TIFF_MAGIC
    except OSError:
        return False


def _tasks(df: DataFrame, work: Callable[[str, str], tuple[str, str]], parts: int | None) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for path, target in zip(pdf["path"], pdf["target"]):
                try:
                    status, message = work(path, target)
                except Exception as e:  # noqa: BLE001 - one image must not end the run
                    status, message = "failed", f"{type(e).__name__}: {e}"
                out.append((path, status, message))
            yield pd.DataFrame(out, columns=["path", "status", "message"])

    rows = df.select("path", "target")
    return (rows.repartition(parts) if parts else rows).mapInPandas(run, STATUS)


def array_bytes(pixels: np.ndarray, path: str) -> bytes:
    """An image in the format of the path's ending: .npy, .tif (deflated) or .png."""
    if path.endswith(".png"):
        return png.encode(pixels)
    if path.endswith(".tif"):
        return tiff.encode(pixels, deflate=True)
    if not path.endswith(".npy"):
        raise ValueError(f"format of {os.path.basename(path)} is not supported")
    out = io.BytesIO()
    np.save(out, pixels)
    return out.getvalue()


def load_mask(path: str) -> np.ndarray:
    """A mask of .npy or .png as 0/1."""
    if path.endswith(".png"):
        pixels = png.decode(store.read(path))
        return ((pixels if pixels.ndim == 2 else pixels.max(axis=2)) > 0).astype(np.uint8)
    if not path.endswith(".npy"):
        raise ValueError(f"mask format of {os.path.basename(path)} is not supported")
    return (np.load(io.BytesIO(store.read(path))) > 0).astype(np.uint8)


def make_masks(paths: DataFrame, downsample: float = 0.2, least_area: int = 1000, parts: int | None = None) -> DataFrame:
    """``(path, status, message)`` for ``path, target``: ok, skipped, no_tissue or failed. A target of zero bytes is made again."""

    def work(path: str, target: str) -> tuple[str, str]:
        if store.size(target):
            return "skipped", ""
        mask = masks.tissue_mask(tiff.decode(store.read(path)), downsample, least_area)
        store.write(target, array_bytes(mask * 255 if target.endswith(".png") else mask, target))
        return ("ok", "") if mask.any() else ("no_tissue", "empty mask")

    return _tasks(paths, work, parts)


def make_crops(paths: DataFrame, mask_of: Callable[[str], str], padding: int = 5, parts: int | None = None) -> DataFrame:
    """Crops of ``path`` to ``target`` (.npy, .tif or .png): ok, skipped, missing_mask, no_tissue or failed."""

    def work(path: str, target: str) -> tuple[str, str]:
        if store.size(target):
            return "skipped", ""
        if store.size(mask_of(path)) is None:
            return "missing_mask", mask_of(path)
        pixels = tiff.decode(store.read(path))
        part = masks.crop(pixels, load_mask(mask_of(path)), padding)
        if part is None:
            return "no_tissue", "empty mask"
        store.write(target, array_bytes(part, target))
        return "ok", ""

    return _tasks(paths, work, parts)


def fetch_image(url: str, target: str, fetch: Fetcher, timeout: float) -> tuple[bool, str, bool]:
    """(done, message, whether another try may help)."""
    try:
        status, kind, body, size = fetch(url, timeout)
    except Exception as e:  # noqa: BLE001 - whatever the transport raises is a failed try
        return False, f"{type(e).__name__}: {e}", True
    if status != 200:
        return False, f"HTTP {status}", not 400 <= status < 500
    if not kind.startswith("image/"):
        return False, f"content type {kind}", True
    if size is not None and size != len(body):
        return False, f"{len(body)} of {size} bytes", True
    if len(body) < TIFF_LEAST_BYTES or body[:4] not in TIFF_MAGIC:
        return False, "no TIFF", True
    store.write(target, body)
    return True, "", False


def download(rows: DataFrame, order: Sequence[str] = ("idr", "hpa"), fetch: Fetcher = http_fetch, retries: int = 2, timeout: float = 60.0, parts: int | None = None) -> DataFrame:
    """``(image_id, status, source, message)`` for rows of ``image_id, target, urls`` (an array of ``source, url``).

    A valid target is skipped. Each source is tried ``retries`` times more unless it answers 4xx; then the next one.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for image, target, urls in zip(pdf["image_id"], pdf["target"], pdf["urls"]):
                out.append((image, *_download_one(target, list(urls), fetch, retries, timeout)))
            yield pd.DataFrame(out, columns=["image_id", "status", "source", "message"])

    kept = rows.select("image_id", "target", F.filter("urls", lambda u: u["source"].isin(list(order))).alias("urls"))
    return (kept.repartition(parts) if parts else kept).mapInPandas(run, DOWNLOAD)


def _download_one(target: str, urls: Sequence, fetch: Fetcher, retries: int, timeout: float) -> tuple[str, str, str]:
    if valid_file(target):
        return "skipped", "", ""
    notes = []
    for u in urls:
        message = ""
        for _ in range(retries + 1):
            done, message, again = fetch_image(u["url"], target, fetch, timeout)
            if done:
                return "ok", u["source"], "; ".join(notes)
            if not again:
                break
        notes.append(f"{u['source']}: {message}")
    return "failed", "", "; ".join(notes) or "no url"


def verify(paths: DataFrame, delete_corrupt: bool = False, parts: int | None = None) -> DataFrame:
    """``(path, status, message)``: ok, missing or corrupt after a full decode; corrupt files may be deleted."""

    def work(path: str, _: str) -> tuple[str, str]:
        if store.size(path) is None:
            return "missing", ""
        fine, message = tiff.describe(store.read(path))
        if not fine and delete_corrupt:
            store.delete(path)
        return ("ok" if fine else "corrupt"), message

    return _tasks(paths.select("path", F.lit("").alias("target")), work, parts)
