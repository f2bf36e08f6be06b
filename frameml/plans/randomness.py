"""Random numbers that depend only on row identity and a seed.

``rand()`` draws per partition, so a retry or another partitioning changes the
values.  Hashing a unique id does not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(*keys, seed: int = 0) -> Column:
    """Uniform in the open interval (0, 1) from a hash of ``keys``."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    bits = F.shiftrightunsigned(F.xxhash64(*cols, F.lit(int(seed))), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**53))


def normal(*keys, seed: int = 0) -> Column:
    """Standard normal by the Box-Muller transform of two hashed uniforms."""
    u = uniform(*keys, F.lit("radius"), seed=seed)
    w = uniform(*keys, F.lit("angle"), seed=seed)
    return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(2.0 * math.pi) * w)
