"""Numbers from printed cells. Four coercions with different rules; they aren't interchangeable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina.functions.text import fold_dashes

NUMBER = r"^[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?$"


def _double(c: Column) -> Column:
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def temperature(c: Column) -> Column:
    """Thousands commas go; the minus sign and the en dash are minus."""
    return _double(F.translate(F.trim(F.replace(c, F.lit(","), F.lit(""))), "−–", "--"))


def number(c: Column) -> Column:
    """Thousands commas go; of the dashes only the minus sign counts."""
    return _double(F.translate(F.trim(F.replace(c, F.lit(","), F.lit(""))), "−", "-"))


def typed_cell(c: Column) -> Column:
    """Struct of number and text: strict thousands only, an ellipsis is absence, other text stays text."""
    trimmed = F.trim(c)
    strict = F.when(trimmed.rlike(r"^[-−+]?\d{1,3}(?:[, ]\d{3})*(?:\.\d+)?$|^[-−+]?\d+(?:\.\d+)?$"), F.translate(trimmed, "−, ", "-"))
    value = strict.try_cast("double")
    absent = trimmed.rlike(r"^(?:\.{3}|…)?$")
    return F.struct(value.alias("number"), F.when(value.isNull() & ~absent, trimmed).alias("text"))


def loose_number(c: Column) -> Column:
    """All spaces go and all dashes are minus."""
    return _double(fold_dashes(F.regexp_replace(c, r"[\s\x{00A0}\x{2009}\x{202F},]", "")))


def scale_factor(operation: Column, exponent: Column) -> Column:
    """10**e to multiply, 10**-e to divide, else 1."""
    e = exponent.cast("double")
    return F.coalesce(F.when(operation == "multiply", F.pow(F.lit(10.0), e)).when(operation == "divide", F.pow(F.lit(10.0), -e)), F.lit(1.0))


def split_dual(c: Column) -> Column:
    """Two numbers of ``a (b) [Note]``."""
    cell = F.regexp_replace(c, r"\[Notes?.*$", "")
    return F.struct(
        loose_number(F.regexp_extract(cell, r"^\s*([\d.,\s]+?)\s*(?:\(|$)", 1)).alias("first"),
        loose_number(F.regexp_extract(cell, r"\(([\d.,\s\x{00A0}]+)\)", 1)).alias("second"),
    )


#: Glyphs of vulgar fractions.
FRACTIONS = {"½": " 1/2", "¼": " 1/4", "¾": " 3/4", "⅛": " 1/8", "⅜": " 3/8", "⅝": " 5/8", "⅞": " 7/8"}


def fraction(c: Column) -> Column:
    """``2 1/2`` and ``1½`` as numbers."""
    for glyph, spelled in FRACTIONS.items():
        c = F.replace(c, F.lit(glyph), F.lit(spelled))
    parts = F.filter(F.split(F.trim(c), r"\s+"), lambda x: x != "")

    def value(x: Column) -> Column:
        top, low = F.split_part(x, F.lit("/"), F.lit(1)).try_cast("double"), F.split_part(x, F.lit("/"), F.lit(2)).try_cast("double")
        return F.when(x.contains("/"), F.try_divide(top, low)).otherwise(x.try_cast("double"))

    return F.when(F.size(parts) > 0, F.aggregate(parts, F.lit(0.0), lambda a, x: a + value(x)))


def split_size(c: Column) -> Column:
    """Printed size, inches and DN of ``1½ (40)``."""
    inches = F.regexp_extract(c, r"^([^(]+)", 1)
    return F.struct(F.trim(inches).alias("printed"), fraction(inches).alias("inches"), loose_number(F.regexp_extract(c, r"\(([^)]*)\)", 1)).alias("dn"))


def designator(identification: Column, schedule: Column) -> Column:
    """``40 (STD)``, or whichever of the two is printed."""
    i, s = (F.when(~x.isin("...", ""), x) for x in (identification, schedule))
    return F.when(i.isNotNull() & s.isNotNull(), F.format_string("%s (%s)", s, i)).otherwise(F.coalesce(s, i))


def overlap_ratio(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes with x0, y0, x1, y1."""
    w = F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    h = F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    area = lambda x: (x["x1"] - x["x0"]) * (x["y1"] - x["y0"])
    return F.coalesce(F.try_divide(w * h, area(a) + area(b) - w * h), F.lit(0.0))


def by_units(units: Column, si: Column, us: Column) -> Column:
    """A printed value of the edition in use; nothing is converted."""
    return F.when(units == "SI", si).otherwise(us)
