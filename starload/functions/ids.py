"""Identifier scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Crockford base-32 alphabet used for time-ordered ids (digits then letters without I, L, O, U).
CROCKFORD_ALPHABET = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
# conv(..., 10, 32) emits the digits 0-9 then A-V; these are the letters it uses, in order.
_CONV_BASE32_LETTERS = "ABCDEFGHIJKLMNOPQRSTUV"


def padded_id(prefix: str, n, width: int) -> Column:
    """'ID-00000042' style keys: prefix + number, zero-padded to ``width`` digits at least (longer numbers stay whole)."""
    c = (F.col(n) if isinstance(n, str) else n).cast("string")
    return F.concat(F.lit(prefix), F.lpad(c, F.greatest(F.length(c), F.lit(width)), F.lit("0")))


def time_ordered_id(epoch_ms, key) -> Column:
    """26-character id that sorts by time: 10 base-32 characters of the millisecond timestamp followed by
    16 hex characters of ``md5(key)``.  Deterministic in (time, key), so a retried task yields the same id."""
    ms = F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms
    k = F.col(key) if isinstance(key, str) else key
    base32 = F.translate(F.conv(ms.cast("bigint").cast("string"), 10, 32), _CONV_BASE32_LETTERS,
                         CROCKFORD_ALPHABET[10:])
    return F.concat(F.lpad(base32, 10, "0"), F.upper(F.substring(F.md5(k.cast("string")), 1, 16)))
