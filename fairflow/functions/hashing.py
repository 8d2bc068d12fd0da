"""Hash-derived values: the same for any partitioning, retry or engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _text(keys) -> list[Column]:
    return [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]


def uniform(keys, seed: int, method: str = "md5") -> Column:
    """A number in [0, 1) drawn from the row's key.

    Unlike ``rand(seed)`` it does not depend on how rows are partitioned, so a recomputed
    task draws the same numbers.  ``md5`` takes the first 32 bits of
    ``md5(key1:key2:...:seed)``, which any engine can reproduce.  ``xxhash64`` is about ten
    times cheaper, hashes the columns without turning them into text, and keeps 53 bits.
    """
    if method == "xxhash64":
        columns = [F.col(k) if isinstance(k, str) else k for k in keys]
        bits = F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 11)
        return bits.cast("double") / F.lit(9007199254740992.0)
    if method != "md5":
        raise ValueError(f"unknown method {method!r}: use 'md5' or 'xxhash64'")
    digest = F.md5(F.concat_ws(":", *_text(keys), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def fingerprint(*keys) -> Column:
    """A row fingerprint: md5 of the given columns joined by ``:``."""
    return F.md5(F.concat_ws(":", *_text(keys)))
