"""Random variates as column expressions.

A draw is a function of its name alone: the 128 bits of the name's MD5 give three uniform numbers. Draws therefore do
not depend on partitions or retries, stay inside the JVM, and any engine with the usual functions can replay them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylens.functions.expr import let

TRIES = 8  # a gamma draw of shape 1 or more is refused in at most 5 of 100 tries
SPLITS = 64  # halvings that bring any long to 0


def _bits(code: Column, start: int, digits: int) -> Column:
    """A number inside (0, 1) from hexadecimal digits."""
    return (F.conv(F.substring(code, start, digits), 16, 10).cast("double") + 0.5) / float(16**digits)


def named(*parts: Column | str | int) -> Column:
    return F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])


def uniform(name: Column) -> Column:
    return _bits(F.md5(name), 1, 11)


def gamma(name: Column, shape: Column) -> Column:
    """Marsaglia and Tsang's method for a shape of at least 1: a cube of a shifted normal number, refused now and then. In
    the case of TRIES refusals, with a probability below 1e-10, the centre of the law is returned."""
    def attempt(j: Column, d: Column) -> Column:
        def from_code(code: Column) -> Column:
            normal = F.sqrt(-2.0 * F.ln(_bits(code, 1, 11))) * F.cos(2 * math.pi * _bits(code, 12, 11))
            return let(normal, lambda x: let(1.0 + x / F.sqrt(9.0 * d), lambda t: let(t * t * t, lambda g: F.when(
                (t > 0) & (F.ln(_bits(code, 23, 10)) < 0.5 * x * x + d - d * g + d * F.ln(g)), d * g))))
        return let(F.md5(named(name, j)), from_code)

    def drawn(d: Column) -> Column:
        tries = F.array(*[F.lit(k) for k in range(TRIES)])
        return F.aggregate(tries, F.lit(None).cast("double"), lambda got, j: F.coalesce(got, attempt(j, d)),
                           lambda got: F.coalesce(got, d))

    return let(shape.cast("double") - 1.0 / 3.0, drawn)


def beta(name: Column, a: Column, b: Column) -> Column:
    return let(gamma(named(name, "a"), a), lambda x: x / (x + gamma(named(name, "b"), b)))


def binomial(name: Column, n: Column, p: Column) -> Column:
    """Number of n uniform draws below p. The middle one of them follows a beta law and tells on which side half of the
    draws lie, so each step halves what is left: log2(n) steps instead of n draws, with exactly the binomial law."""
    def split(s: Column, j: Column) -> Column:
        half = F.floor((s["n"] + 1) / 2)

        def by_middle(b: Column) -> Column:
            below = F.struct((s["n"] - half).alias("n"), F.least(F.lit(1.0), (s["p"] - b) / (1 - b)).alias("p"), (s["x"] + half).alias("x"))
            above = F.struct((half - 1).alias("n"), F.least(F.lit(1.0), s["p"] / b).alias("p"), s["x"].alias("x"))
            return F.when(b <= s["p"], below).otherwise(above)
        return F.when(s["n"] <= 0, s).otherwise(let(beta(named(name, j), half, s["n"] + 1 - half), by_middle))

    start = F.struct(n.cast("bigint").alias("n"), p.cast("double").alias("p"), F.lit(0).cast("bigint").alias("x"))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(n.cast("double") + 1.0)).cast("int"))
    return F.aggregate(steps, start, split, lambda s: s["x"])


def median_ranks(name: Column, n: Column) -> Column:
    """(low, high): the ranks that carry the median of n draws with replacement from n ordered members.

    Of n uniform draws in order, the m-th follows the beta law of m and n - m + 1 and hits member ceil(n * u). For even n
    the next one is the least of the n - m draws above it. So a resample costs two or three numbers instead of n draws and
    has exactly the law of a full one.
    """
    m = F.floor((n + 1) / 2)

    def ranks(u: Column) -> Column:
        above = 1.0 - (1.0 - u) * F.pow(uniform(named(name, "c")), 1.0 / (n - m))
        low = F.greatest(F.lit(1).cast("bigint"), F.least(n, F.ceil(n * u)))
        return let(low, lambda at: F.struct(at.alias("low"), F.when(n % 2 == 1, at).otherwise(
            F.greatest(at, F.least(n, F.ceil(n * above)))).alias("high")))
    return let(beta(name, m, n - m + 1), ranks)
