"""Key expressions: PMID normalisation and the 4-key (F1, F2)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must match the source pipeline.
KEY_COLUMNS = ("subject_curie", "predicate", "object_curie", "PMID")
REQUIRED_COLUMNS = KEY_COLUMNS
PMID_PREFIX = "PMID:"

# What Python's str.strip() strips: the Unicode White_Space set and U+001C to U+001F.
WHITE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
         + "\u2028\u2029\u202f\u205f\u3000")


def py_strip(col: Column | str) -> Column:
    """Strip leading and trailing whitespace the way Python's ``str.strip`` does; the
    argument is evaluated once."""
    return F.btrim(F.col(col) if isinstance(col, str) else col, F.lit(WHITE))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or it with underscores until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def normalize_pmid(col: Column | str) -> Column:
    """strip, then drop one leading ``PMID:`` (any case); no second strip."""
    bare = py_strip(col)
    # the usual spelling needs no regex
    return F.when(F.startswith(bare, F.lit(PMID_PREFIX)), F.substring(bare, len(PMID_PREFIX) + 1, 1 << 30)) \
        .otherwise(F.regexp_replace(bare, f"^(?iu:{PMID_PREFIX})", ""))


#: Bytes of a packed key; what stands before the bytes of a key that is no hash.
PACKED = 32
_PLAIN = f"X'{'00' * (PACKED + 1)}'"


def packed(key: Column | str) -> Column:
    """A prompt key for the way through shuffles: a SHA-256 in lowercase hex digits as its 32
    bytes, any other text as its own bytes after 33 zeros, so that no two keys become one."""
    key = F.col(key) if isinstance(key, str) else key
    raw = F.when(F.length(key) == 2 * PACKED, F.unhex(key))
    return F.when(F.lower(F.hex(raw)) == key, raw).otherwise(F.concat(F.expr(_PLAIN), key.cast("binary")))


def unpacked(key: Column | str) -> Column:
    """The prompt key that ``packed`` made ``key`` of."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(F.octet_length(key) == PACKED, F.lower(F.hex(key))) \
        .otherwise(F.substring(key, PACKED + 2, 1 << 30).cast("string"))


def key_columns(prefix: str = "") -> list[Column]:
    """the four key columns as stripped strings."""
    return [
        py_strip(F.col(c).cast("string")).alias(prefix + c) for c in KEY_COLUMNS
    ]
