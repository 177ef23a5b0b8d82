"""Text columns: plate-layout names, file names, scene records."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that must not occur in a formatted name.
SYMBOLS = ['~', '!', '@', '#', '$', '%', '^', '&', '*',
           '(', ')', '`', ';', '<', '>', '.', '?', ',', '[',
           ']', '{', '}', '|', '°', '§', '/', 'ß', '+', '-']


def normalize_text(c: Column, symbols: Sequence[str] = SYMBOLS, replacement: str = "_",
                   lower: bool = False) -> Column:
    """Symbols become ``replacement`` and blanks vanish, in one pass over the string."""
    if len(replacement) == 1 and all(len(s) == 1 for s in symbols):
        out = F.translate(c, "".join(symbols) + " ", replacement * len(symbols))
    else:
        pattern = "|".join(re.escape(s) for s in symbols)
        out = F.translate(F.regexp_replace(c, pattern, replacement), " ", "")
    return F.lower(out) if lower else out


def trailing_number(c: Column, regex: str = r"(\d+)$") -> Column:
    """Integer made of the digits that end the string, NULL without any."""
    digits = F.regexp_extract(c, regex, 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def split_text_number(c: Column, number_type: str | None = None) -> Column:
    """Struct (prefix, number); both NULL where the string does not end with digits."""
    number = F.regexp_extract(c, r"^(.*?)(\d+)$", 2)
    hit = number != ""
    prefix = F.when(hit, F.regexp_extract(c, r"^(.*?)(\d+)$", 1))
    number = F.when(hit, number)
    return F.struct(prefix.alias("prefix"),
                    (number.cast(number_type) if number_type else number).alias("number"))


def token(c: Column, separator: str, position: int) -> Column:
    """Zero-based token of a split string; negative positions count from the end."""
    index = position + 1 if position >= 0 else position
    return F.try_element_at(F.split(c, re.escape(separator)), F.lit(index))


def parse_name(c: Column, fields: Mapping[str, object], separator: str = "_",
               replace_blank: bool = False) -> list[Column]:
    """One column per field of a structured file name.

    A field is a literal, or ``(position, sub_separator, sub_position, method)``. Without a
    sub-separator the whole token is returned; a sub-position out of range falls back to
    the whole token; ``method='try_int'`` normalises integers and keeps other text.
    """
    if replace_blank:
        c = F.replace(c, F.lit(" "), F.lit(separator))
    out = []
    for name, how in fields.items():
        if not isinstance(how, tuple):
            out.append((how if isinstance(how, Column) else F.lit(how)).alias(name))
            continue
        position, sub_sep, sub_pos, method = how
        whole = token(c, separator, position)
        part = whole
        if sub_sep is not None and sub_pos is not None:
            part = token(whole, sub_sep, sub_pos)
            if method == "try_int":
                part = F.coalesce(part.try_cast("bigint").cast("string"), part)
            part = F.coalesce(part, whole)
        out.append(part.alias(name))
    return out


def output_name(stem: Column, experiment: Column, scene: Column, suffix: str = ".ome.tif",
                separator: str = "_") -> Column:
    """File name of a saved scene; dots of the experiment become ``p``."""
    safe = F.replace(experiment, F.lit("."), F.lit("p"))
    return F.concat(F.concat_ws(separator, stem, safe, scene), F.lit(suffix))


def prefix_keys(m: Column, prefix: str = "custom_") -> Column:
    """Prepend ``prefix`` to every key of a map column."""
    return F.transform_keys(m, lambda k, _v: F.concat(F.lit(prefix), k))


def scene_record(sizes: Mapping[str, Column], physical: Mapping[str, Column] | None = None,
                 **extra: Column) -> list[Column]:
    """Columns of one scene: dims order, size per dimension, physical sizes, free fields.

    ``sizes`` maps dimension letters in storage order (T, C, Z, Y, X) to their lengths. Only
    dimensions longer than one enter the order string, and a physical Z size is kept only
    where the scene has more than one plane.
    """
    physical = physical or {}
    letters = F.array(*[F.when(size > 1, F.lit(d)) for d, size in sizes.items()])
    out = [F.array_join(letters, "").alias("dims_order")]
    out += [size.alias(f"size_{d.lower()}") for d, size in sizes.items()]
    for d, um in physical.items():
        c = F.when(sizes[d] > 1, um) if d == "Z" else um
        out.append(c.alias(f"physical_size_{d.lower()}"))
    return out + [c.alias(k) for k, c in extra.items()]


def stamp_date(run_ts, fmt: str = "yyMMdd") -> Column:
    """Processing date as text; the instant is an argument, so a rerun gives the same rows."""
    return F.date_format(F.lit(run_ts).cast("timestamp"), fmt)
