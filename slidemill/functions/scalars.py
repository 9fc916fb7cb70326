"""Scalar functions of the dataset pipeline as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordinal codes of the annotation vocabularies.
STAINING_CODES = {"not detected": 0, "low": 1, "medium": 2, "high": 3}
INTENSITY_CODES = {"negative": 0, "weak": 1, "moderate": 2, "strong": 3}
QUANTITY_CODES = {"none": 0, "<25%": 1, "25%-75%": 2, "25-75%": 2, "25% - 75%": 2, ">75%": 3}
# First bytes of a TIFF file and its least size in bytes.
TIFF_MAGIC = (b"II*\0", b"MM\0*")
TIFF_LEAST_BYTES = 1024


def strip(value: Column) -> Column:
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def mapped(value: Column, mapping: Mapping, default: object = None) -> Column:
    """Dictionary lookup; ``default`` for unknown and null values."""
    out = F.lit(default)
    for k, v in mapping.items():
        out = F.when(value == F.lit(k), F.lit(v)).otherwise(out)
    return out


def ordinal_code(value: Column, codes: Mapping[str, int]) -> Column:
    """The code of a stripped, lower-cased value; -1 if unknown or missing."""
    return mapped(F.lower(strip(value)), codes, -1).cast("int")


def location_code(value: Column) -> Column:
    """3 for nuclear and cytoplasmic/membranous, 2 and 1 for one of them, 0 for none, else -1."""
    v = F.lower(value)
    outer, nuclear = v.contains("cytoplasmic/membranous"), v.contains("nuclear")
    code = F.when(outer & nuclear, 3).when(nuclear, 2).when(outer, 1).when(strip(v) == "none", 0)
    return code.otherwise(-1).cast("int")


def whole_number_id(value: Column) -> Column:
    """``12.0`` becomes ``12``; anything else stays."""
    return F.when(value.rlike(r"\A\d+\.0\z"), F.regexp_replace(value, r"\.0\z", "")).otherwise(value)


def tif_name(value: Column) -> Column:
    """A lower-case image extension becomes .tif."""
    return F.regexp_replace(value, r"\.(jpe?g|tif|tiff)$", ".tif")


def id_source(value: Column) -> Column:
    """The letters of an id of letters and digits, else ``other``."""
    letters = F.regexp_extract(value, r"^([A-Za-z]+)(\d+)$", 1)
    return F.when(letters == "", "other").otherwise(letters)


def id_number(value: Column) -> Column:
    return F.regexp_extract(value, r"^([A-Za-z]+)(\d+)$", 2).try_cast("bigint")


def id_prefix(value: Column) -> Column:
    """The letters that an id starts with, else ``other``."""
    letters = F.regexp_extract(value, r"^([A-Za-z]+)", 1)
    return F.when(letters == "", "other").otherwise(letters)


def antibody_digits(value: Column) -> Column:
    """The digits of an antibody id without leading zeros; without any, the id without its prefix."""
    digits = F.regexp_extract(value, r"(HPA|CAB)0*(\d+)", 2)
    return F.when(digits != "", digits).otherwise(F.regexp_replace(value, "HPA|CAB", ""))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """The file name without its last extension; a name that only starts with dots keeps it."""
    return F.regexp_replace(basename(path), r"^(\.*[^.].*)\.[^.]*$", "$1")


def segment(path: Column, position: int) -> Column:
    """A part of a path, negative positions from the end; null out of range."""
    return F.try_element_at(F.split(path, "/"), F.lit(position))


def after_marker(path: Column, marker: str) -> Column:
    """What follows the first occurrence of ``marker``, else the path without leading slashes."""
    if not marker:
        return F.regexp_replace(path, "^/+", "")
    at = F.instr(path, marker)
    return F.when(at > 0, F.substring(path, at + len(marker), F.length(path))).otherwise(F.regexp_replace(path, "^/+", ""))


def sorted_join(values: Column, separator: str = ";") -> Column:
    return F.array_join(F.array_sort(values), separator)


def filled(value: Column, default: object = "") -> Column:
    return F.coalesce(value, F.lit(default))


def missing(value: Column) -> Column:
    return value.isNull() | (value == "")


def half_even(value: Column) -> Column:
    return F.bround(value).cast("int")


def percent_text(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def signed_points(share: Column) -> Column:
    return F.format_string("%+.2f pt", share * 100)


def valid_tiff(content: Column, size: Column) -> Column:
    """Large enough and with a TIFF's first bytes."""
    head = F.substring(content, 1, 4)
    return (size >= TIFF_LEAST_BYTES) & head.isin([F.lit(m) for m in TIFF_MAGIC])


def source_urls(order: Sequence[str], columns: Mapping[str, str]) -> Column:
    """``array<struct<source, url>>`` of the non-empty URL columns in the wanted order of sources."""
    unknown = [s for s in order if s not in columns]
    if unknown:
        raise ValueError(f"unknown sources: {unknown}")
    pairs = F.array(*(F.struct(F.lit(s).alias("source"), F.col(columns[s]).alias("url")) for s in order))
    return F.filter(pairs, lambda p: p["url"].isNotNull() & (p["url"] != ""))


def named_paths(pairs: Sequence[str]) -> dict[str, str]:
    """NAME=PATH arguments as a dictionary."""
    out = {}
    for pair in pairs:
        name, sign, path = pair.partition("=")
        if not (name and sign and path):
            raise ValueError(f"expected NAME=PATH, got {pair!r}")
        out[name] = path
    return out
