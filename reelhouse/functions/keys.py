"""Surrogate keys.

A key is the MD5 of the natural-key parts joined by ``-``; a null part is
written as ``<null>``.  Timestamps must enter as epoch seconds
(:func:`epoch_seconds`) so the text, and hence the hash, does not depend on how
an engine prints a time zone.

A key is random text, which no shuffle can compress: rows that are moved with several keys are mostly
keys.  :func:`packed_keys` halves them for the way: 16 bytes instead of 32 digits, and back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the key format.
KEY_SEPARATOR = "-"
NULL_TOKEN = "<null>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """MD5 over the natural-key columns (strings, numbers or epoch seconds)."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds of a TIMESTAMP (floor for sub-second values)."""
    return F.unix_seconds(_col(ts))


# what is no MD5 is packed as it is behind so many zero bytes, and so never has the 16 bytes of one
_PLAIN = bytes(17)


def packed(c) -> Column:
    """A text as bytes: an MD5 in lower-case digits as its 16, any other text as its own behind a mark.  Different
    texts stay different, null stays null."""
    c = _col(c)
    raw = F.unhex(c)
    is_md5 = (F.length(c) == 32) & (F.lower(F.hex(raw)) == c)
    return F.when(is_md5, raw).otherwise(F.concat(F.lit(_PLAIN), c.cast("binary")))


def unpacked(c) -> Column:
    """The text of :func:`packed`."""
    c = _col(c)
    return (F.when(F.length(c) == 16, F.lower(F.hex(c)))
            .otherwise(F.substr(c, F.lit(len(_PLAIN) + 1)).cast("string")))


def key_columns(df: DataFrame) -> list[str]:
    """The surrogate keys of a table: its text columns named ``*_sk``."""
    return [f.name for f in df.schema.fields if f.name.endswith("_sk") and isinstance(f.dataType, T.StringType)]


def packed_keys(df: DataFrame, but: Sequence[str] = ()) -> DataFrame:
    """``df`` with its surrogate keys packed, for a join, grouping or repartition; ``but`` stay as they are."""
    return df.withColumns({c: packed(c) for c in key_columns(df) if c not in but})


def unpacked_keys(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with the packed keys ``names`` as text again."""
    return df.withColumns({c: unpacked(c) for c in names})
