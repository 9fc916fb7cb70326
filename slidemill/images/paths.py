"""Where images, masks and crops are stored."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slidemill.functions.scalars import stem


def image_path(root: Column, local_path: Column, image_id: Column) -> Column:
    return F.concat_ws("/", root, local_path, F.concat(image_id, F.lit(".tif")))


def _beside(path: Column, folder: str, ending: str) -> Column:
    return F.concat(F.regexp_replace(path, "[^/]*$", ""), F.lit(f"{folder}/"), stem(path), F.lit(ending))


def mask_path(path: Column, extension: str = "npy") -> Column:
    return _beside(path, "masks", f"_mask.{extension}")


def crop_path(path: Column, extension: str = "npy") -> Column:
    return _beside(path, "crops", f"_crop.{extension}")
