"""Random draws that depend only on a seed and a row's key.

A draw never depends on row order, partitioning or task retries, so a lost executor
recomputes the same numbers and another engine can reproduce them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_uniform(seed: int, key: Column, i: Column) -> Column:
    """Uniform in (0, 1): the middle of the cell given by the first 52 bits of md5(seed:key:i)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key, i.cast("string")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def keyed_beta(alpha: Column, beta: Column, seed: int, key: Column) -> Column:
    """Beta(alpha, beta) for whole-number parameters.

    With n = alpha + beta - 1, the product of u_i ** (1 / (n - i)) for i = 0 .. m-1 is the
    m-th largest of n uniforms, which is Beta(n - m + 1, m). Counting from the nearer end
    takes only min(alpha, beta) uniforms; from the lower end the result is mirrored.
    """
    n = alpha + beta - 1
    steps = F.least(alpha, beta).cast("int")
    logs = F.transform(
        F.sequence(F.lit(0), steps - 1), lambda i: F.ln(keyed_uniform(seed, key, i)) / (n - i)
    )
    largest = F.exp(F.aggregate(logs, F.lit(0.0), lambda acc, v: acc + v))
    return F.when(beta < alpha, largest).otherwise(1.0 - largest)
