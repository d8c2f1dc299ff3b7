"""Versioned CSV folders, retention of old versions, and the names of sheets."""

from __future__ import annotations

import re
import warnings
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route(base: str, prefix: str, routes: dict[str, str]) -> str:
    """The folder of an output: of the longest key of ``routes`` that its name begins with, else ``base``."""
    kind = max((k for k in routes if prefix.startswith(k)), key=len, default=None)
    if routes and kind is None:
        warnings.warn(f"no route for {prefix!r}: it goes to {base}", stacklevel=2)
    return f"{base}/{routes[kind]}" if kind else base


def write_csv_versioned(df: DataFrame, base: str, prefix: str, changed: bool, now: datetime, routes: dict[str, str] | None = None) -> str:
    """Writes ``<prefix>_latest``, and a stamped version too if ``changed``; returns what was written last."""
    home = route(base, prefix, routes or {})
    targets = [f"{home}/{prefix}_latest"] + [f"{home}/{prefix}_{now:%Y%m%d_%H%M%S}"] * changed
    for path in targets:
        df.write.mode("overwrite").csv(path, header=True)
    return targets[-1]


def encoded(name: str) -> Column:
    """A column's value as text that tells its name, type-neutral form and NULL apart from every other: name, length and value, or a bare mark."""
    column = F.col("`" + name.replace("`", "``") + "`")
    value = F.coalesce(F.to_json(F.struct(column.alias("v")), {"ignoreNullFields": "false"}), F.lit(""))
    return F.concat(F.lit(f"{len(name)}:{name}="), F.when(column.isNull(), "-").otherwise(F.concat(F.length(value).cast("string"), F.lit(":"), value)))


def content_hash(df: DataFrame) -> DataFrame:
    """One row (n_rows, content): equal for equal rows in any order, repeated rows counted, whatever the order of columns.

    A row is written injectively (names, lengths, marks for NULL), so that rows which differ anywhere have different
    texts; the first 60 bits of their SHA-256 are summed, which needs no order and combines before the shuffle.
    """
    row = F.sha2(F.concat(F.lit(""), *[encoded(c) for c in sorted(df.columns)]), 256)
    part = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")
    return df.select(part.alias("part")).agg(F.count("*").alias("n_rows"), F.coalesce(F.sum("part"), F.lit(0)).cast("string").alias("content"))


def retention(files: DataFrame, archives: bool = False) -> DataFrame:
    """``files`` (path) plus action: stamped versions go, latest ones and archives (unless asked) stay."""
    name = F.element_at(F.split("path", "/"), -1)
    stamped, latest = F.rlike(name, F.lit(r"_\d{8}_\d{6}(\.[A-Za-z0-9]+)?$")), F.rlike(name, F.lit(r"(?i)_latest(\.[A-Za-z0-9]+)?$"))
    kept = F.lit(False) if archives else F.rlike("path", F.lit(r"(?i)(^|/)archives/"))
    return files.withColumn("action", F.when(stamped & ~latest & ~kept, "delete").otherwise("keep"))


MAX_NAME = 31


#: Sheets that a report always has; an entity's sheet never takes their names.
FIXED_SHEETS = ("00_Legenda", "01_Summary")


def workbook_names(names: list[str], reserved: tuple[str, ...] = ()) -> list[str]:
    """Each name without ``[]:*?/\\``, of at most MAX_NAME characters and unlike all others and ``reserved``, case aside."""
    taken = {r.lower() for r in reserved}
    out = []
    for name in names:
        base = re.sub(r"[\[\]:*?/\\]", "", name).strip()[:MAX_NAME] or "Sheet"
        new, n = base, 1
        while new.lower() in taken:
            n += 1
            new = f"{base[: MAX_NAME - 1 - len(str(n))]}~{n}"
        taken.add(new.lower())
        out.append(new)
    return out
