"""Reproducible uniforms from a row key: md5 of key|salt|seed, first eight hex digits."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = 2**32


def hash32(key: Column | str, salt: str, seed: int) -> Column:
    """Integer in [0, 2^32) that depends only on (key, salt, seed), never on row order."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(salt), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def uniform(key: Column | str, salt: str, seed: int) -> Column:
    return hash32(key, salt, seed) / F.lit(float(SPACE))
