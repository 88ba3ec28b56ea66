"""Small text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the producer's behaviour.
PREVIEW_CHARS = 50
PREVIEW_SUFFIX = "..."


def text_preview(col, n: int = PREVIEW_CHARS) -> Column:
    """First ``n`` characters plus ``...`` when the text is longer than ``n``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.char_length(c) > n, F.concat(F.substring(c, 1, n), F.lit(PREVIEW_SUFFIX))).otherwise(c)


def iso_timestamp(col) -> Column:
    """ISO-8601 text of a timestamp: ``yyyy-MM-ddTHH:mm:ss`` plus ``.ffffff`` only when non-zero."""
    c = F.col(col) if isinstance(col, str) else col
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(c, "SSSSSS")
    return F.when(c.isNull(), F.lit(None).cast("string")) \
        .when(frac == "000000", base).otherwise(F.concat(base, F.lit("."), frac))
