"""Random-looking numbers that depend on the row's key and a seed only.

``rand`` depends on how the rows are partitioned; these do not, so a lost and
recomputed task produces the same rows.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadstream import params as p

def uniforms(*key: Column, seed: int = p.SEED, salt: str = "") -> list[Column]:
    """Four independent numbers in [0, 1) from one digest of the key.

    A digest holds four 32-bit numbers, two in each half, which is read as one BIGINT.
    """
    digest = F.md5(F.concat_ws("|", F.lit(f"{seed}{salt}"), *[k.cast("string") for k in key]))
    halves = [F.conv(F.substring(digest, i, 16), 16, -10).cast("bigint") for i in (1, 17)]
    low = F.lit((1 << 32) - 1)
    numbers = [n for h in halves for n in (F.shiftrightunsigned(h, 32), h.bitwiseAND(low))]
    return [n / float(1 << 32) for n in numbers]


def choose(u: Column, shares, values) -> Column:
    """The value whose cumulative share is the first above ``u``."""
    picked, total = F, 0.0
    for share, value in list(zip(shares, values))[:-1]:
        total += share
        picked = picked.when(u < total, F.lit(value))
    return picked.otherwise(F.lit(values[-1]))


def between(u: Column, low: float, high: float) -> Column:
    return F.lit(low) + u * (high - low)
