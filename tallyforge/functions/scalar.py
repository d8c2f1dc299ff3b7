"""Column expressions: counts, win rates, shares, labels, Beta functions and the normal distribution."""

from __future__ import annotations

import math
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def count_of(x: Column, kind: str | None = None) -> Column:
    """Text or number to a count: what is no number is 0, negatives are 0; fractions and what no long holds are errors.

    Numbers may be written as 12, "12.0", 1e3 or " 7 ". ``kind``, where known, is the column's type: integers and doubles need no text.
    """
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.greatest(F.coalesce(x.cast("bigint"), F.lit(0)), F.lit(0)).cast("bigint")
    text = F.trim(x.cast("string"))
    if kind == "double":
        number = F.when(~F.isnan(x), F.greatest(x, F.lit(0.0)))
        number = F.coalesce(number, F.lit(0.0))
        wrong = (number != F.rint(number)) | (number >= F.lit(2.0**63))
        return F.when(wrong, F.raise_error(F.concat(F.lit("not a whole count: "), text))).otherwise(number.cast("bigint")).cast("bigint")
    # A failed try_cast throws inside, which costs more than all else: only what may be an integer is tried.
    whole = F.when(F.rlike(text, F.lit(r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$")), text.try_cast("bigint"))
    number = F.when(F.rlike(text, F.lit(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$")), text.try_cast("double"))
    number = F.greatest(F.coalesce(number, F.lit(0.0)), F.lit(0.0))
    wrong = (number != F.rint(number)) | (number >= F.lit(2.0**63))
    read = F.when(wrong, F.raise_error(F.concat(F.lit("not a whole count: "), text))).otherwise(number.cast("bigint"))
    return F.when(whole.isNotNull(), F.greatest(whole, F.lit(0))).otherwise(read).cast("bigint")


def win_rate(w: Column, l: Column, t: Column | None = None, mode: str = "exclude") -> Column:
    """Percent won: without ties, or ("half") with ties as half a win. NULL without matches."""
    if mode == "half":
        num, den = w + F.lit(0.5) * t, w + l + t
    elif mode == "exclude":
        num, den = w, w + l
    else:
        raise ValueError(f"unknown tie mode {mode!r}")
    return F.when(den > 0, F.bround(F.lit(100.0) * num / den, 2))


def win_rate_all(w: Column, n: Column) -> Column:
    """Percent won of all matches, ties included; 0 without matches."""
    return F.when(n > 0, F.bround(F.lit(100.0) * w / n, 2)).otherwise(F.lit(0.0))


def parse_percent(x: Column) -> Column:
    """``"12,5 %"`` (also with no-break spaces) to 12.5; NULL for what is no number."""
    return F.trim(F.replace(F.replace(F.replace(x, F.lit("\u00a0"), F.lit("")), F.lit("%"), F.lit("")), F.lit(","), F.lit("."))).try_cast("double")


def share_fraction(x: Column) -> Column:
    """A share as a fraction: above 1 it is taken as percent; clipped to [0, 1]."""
    return F.least(F.greatest(F.when(x > 1, x / 100.0).otherwise(x), F.lit(0.0)), F.lit(1.0))


def confidence(n: Column, k: Column | float) -> Column:
    k = k if isinstance(k, Column) else F.lit(float(k))
    return F.when(n > 0, n / (n + k)).otherwise(F.lit(0.0))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high)))


def label_key(x: Column) -> Column:
    """The key under which spellings of an ASCII label meet: trimmed, inner space single, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " ")))


def outer_key(x: Column) -> Column:
    """As ``label_key``, inner space as it is."""
    return F.lower(F.trim(F.coalesce(x, F.lit(""))))


def label_key_text(label: str) -> str:
    """NFKC, white space single, case folded."""
    return " ".join(unicodedata.normalize("NFKC", label).split()).casefold()


@F.arrow_udf(T.StringType())
def label_key_unicode(x: pa.Array) -> pa.Array:
    """As ``label_key``, for all of Unicode: NFKC and case folding, which Spark has no function for."""
    return pa.array([None if s is None else label_key_text(s) for s in x.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def outer_key_unicode(x: pa.Array) -> pa.Array:
    """As ``outer_key``, for all of Unicode."""
    return pa.array([None if s is None else unicodedata.normalize("NFKC", s).strip().casefold() for s in x.to_pylist()], pa.string())


def any_outer_key(x: Column) -> Column:
    """``outer_key``; labels beyond ASCII by ``outer_key_unicode``."""
    other = F.when(F.rlike(x, F.lit(r"[^\x00-\x7F]")), x)
    return F.when(other.isNotNull(), outer_key_unicode(other)).otherwise(outer_key(x))


def any_label_key(x: Column) -> Column:
    """``label_key`` of ASCII labels, in the JVM; only others go through ``label_key_unicode``."""
    other = F.when(F.rlike(x, F.lit(r"[^\x00-\x7F]")), x)
    return F.when(other.isNotNull(), label_key_unicode(other)).otherwise(label_key(x))


#: Arguments below this are raised first: ln Gamma(x) = ln Gamma(x + n) - ln(x (x + 1) ... (x + n - 1)).
LEAST_ARGUMENT = 10


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0 by Stirling's series, in the JVM; NULL elsewhere. Good to about 1e-13 of its size."""
    raised = F.when(x < LEAST_ARGUMENT, x + LEAST_ARGUMENT).otherwise(x)
    product = x
    for k in range(1, LEAST_ARGUMENT):
        product = product * (x + k)
    inverse = 1 / (raised * raised)
    series = F.lit(0.0)
    # B(2k) / (2k (2k - 1)) of Stirling's series, k from 8 to 1.
    for c in (-3617 / 122400, 1 / 156, -691 / 360360, 1 / 1188, -1 / 1680, 1 / 1260, -1 / 360, 1 / 12):
        series = series * inverse + c
    value = (raised - 0.5) * F.ln(raised) - raised + 0.5 * math.log(2 * math.pi) + series / raised
    return F.when(x > 0, value - F.when(x < LEAST_ARGUMENT, F.ln(product)).otherwise(F.lit(0.0)))


def log_beta(a: Column, b: Column) -> Column:
    return log_gamma(a) + log_gamma(b) - log_gamma(a + b)


def normal_cdf(z: Column) -> Column:
    """Phi(z) by its series around 0, which has only positive terms."""
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(120)), F.struct(z.alias("term"), z.alias("total")),
        lambda s, n: F.struct((s["term"] * z * z / (2 * n + 1)).alias("term"), (s["total"] + s["term"] * z * z / (2 * n + 1)).alias("total")),
        lambda s: s["total"],
    )
    return F.lit(0.5) + F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * terms


def split_counts(w: Column, l: Column, rho: float) -> dict[str, Column]:
    """A fixed train and test split of a cell's wins and losses: about ``rho`` of its matches are test.

    Four matches or more give at least two test matches; some match always stays for training.
    """
    n = w + l
    aim = F.greatest(F.lit(1), F.rint(F.lit(rho) * n).cast("bigint"))
    aim = F.when(n >= 4, F.greatest(aim, F.lit(2))).otherwise(aim)
    test = F.when(n <= 1, F.lit(0)).otherwise(F.least(aim, n - 1)).cast("bigint")
    won = F.when(n > 0, F.least(F.greatest(F.rint(test * w / n).cast("bigint"), F.lit(0)), w)).otherwise(F.lit(0)).cast("bigint")
    lost = F.least(F.greatest(test - won, F.lit(0)), l)
    return {"w_train": w - won, "l_train": l - lost, "w_test": won, "l_test": lost}
