"""Canonical forms of the identifiers that occur in several spellings.

Every function takes a column and returns a column that is null where no
identifier can be read. All are built-in expressions and stay inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind: control blanks, no-break and other Unicode separators.
BLANK = r"[\s\p{Z}\x{0B}\x{85}]"
#: The same characters one by one.
BLANKS = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))

# The accepted spellings of labels and versions, after lower-casing
# and removing everything but letters and digits.
LABEL_PATTERNS = {
    "train": "^tra(in(ing)?)?(set|data|split)?$",
    "val": "^val(id(ation)?)?(set|data|split)?$",
    "test": "^test(ing)?(set|data|split)?$",
}
VERSION_PATTERN = r"^\s*v?(?:ersion)?[\s._-]*([12])(?:\.0+)*\s*$"


def none_if(value: Column, empty: str = "") -> Column:
    return F.when(value != empty, value)


def strip_blank(value: Column) -> Column:
    """Without outer white space of any kind."""
    return F.btrim(value, F.lit(BLANKS))


def squash_blank(value: Column) -> Column:
    """Without outer white space, inner runs made one blank."""
    return F.trim(F.regexp_replace(value, f"{BLANK}+", " "))


def normal_value(value: Column) -> Column:
    """Lower case with white space squashed; null for a missing value."""
    return none_if(F.lower(squash_blank(value)))


def _unescaped(value: Column) -> Column:
    """With plain slashes, underscores and hyphens; only values with a percent sign are searched."""
    slashes = F.translate(value, "\\", "/")
    plain = slashes
    for code, char in (("5f", "_"), ("2d", "-"), ("2f", "/")):
        plain = F.regexp_replace(plain, f"(?i)%{code}", char)
    return F.when(value.contains("%"), plain).otherwise(slashes)


def image_identity(value: Column) -> Column:
    """NUMBER_LETTER_ROW_COLUMN in capitals, out of an id, a file name, a path or a URL.

    A canonical value is taken as it is; of any other the last path segment is read.
    """
    name = F.substring_index(_unescaped(value), "/", -1)
    found = F.regexp_extract(name, r"^\s*([0-9]+_[A-Za-z]_[0-9]+_[0-9]+)(?:\.[A-Za-z]+)?(?:[?#].*)?\s*$", 1)
    return F.when(value.rlike("^[0-9]+_[A-Z]_[0-9]+_[0-9]+$"), value).otherwise(none_if(F.upper(found)))


def antibody_identity(value: Column) -> Column:
    """Three capital letters and a number without leading zeros."""
    pattern = r"^[^A-Za-z0-9]*([A-Za-z]{3})[^A-Za-z0-9]*0*([0-9]+)[^A-Za-z0-9]*$"
    other = none_if(F.concat(F.upper(F.regexp_extract(value, pattern, 1)), F.regexp_extract(value, pattern, 2)))
    return F.when(value.rlike("^[A-Z]{3}[1-9][0-9]*$"), value).otherwise(other)


def gene_identity(value: Column) -> Column:
    """ENSG and 11 digits, without version suffix."""
    other = none_if(F.upper(F.regexp_extract(value, r"^\s*([Ee][Nn][Ss][Gg][0-9]{11})(?:\.[0-9]+)?\s*$", 1)))
    return F.when(value.rlike("^ENSG[0-9]{11}$"), value).otherwise(other)


def label_identity(value: Column) -> Column:
    """train, val or test; null for any unknown label."""
    letters = F.regexp_replace(F.lower(value), "[^a-z0-9]", "")
    out = F.lit(None).cast("string")
    for label, pattern in LABEL_PATTERNS.items():
        out = F.when(letters.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def version_identity(value: Column) -> Column:
    """v1 or v2; null for any unknown version."""
    number = F.regexp_extract(F.lower(value), VERSION_PATTERN, 1)
    return F.when(number != "", F.concat(F.lit("v"), number))


def mirror_path_identity(value: Column) -> Column:
    """BATCH/PARENT/IMAGE_ID out of a mirror path or URL in any spelling; null if there is none."""
    plain = _unescaped(value)
    single = F.when(plain.contains("//"), F.regexp_replace(plain, "/+", "/")).otherwise(plain)
    tail = F.substring_index(single, "/", -3)
    named = F.concat(F.lower(F.substring_index(tail, "/", 2)), F.lit("/"), image_identity(F.substring_index(single, "/", -1)))
    return F.when(tail.rlike(r"^[^/\s]+/[^/\s]+/[^/]+$"), named)


def month_of(moment: Column) -> Column:
    """The month YYYY-MM of a timestamp or date."""
    return F.date_format(moment, "yyyy-MM")
