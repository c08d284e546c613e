"""Deterministic hash families as native column expressions.

Elements are mapped to integers by the first 32 bits of their MD5 digest, taken
modulo the Mersenne prime P = 2^31 - 1.  A family member is ``(a*x + b) % P``
with ``a, b`` drawn once on the driver from ``random.Random(seed)`` and embedded
as literals, so every executor (and any SQL engine) computes the same values,
independent of partitioning.  ``a, b < P`` keeps ``a*x + b`` below 2^63.

The random sign used by hyperplane LSH is the parity of the same hash: +1 for
odd, -1 for even.
"""

from __future__ import annotations

import random
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The modulus of the linear hash family.
PRIME = 2147483647


def check_modulus(modulus: int) -> int:
    """Moduli up to 2^31 - 1 keep ``a*x + b`` (all three below the modulus) inside a bigint."""
    if not 2 <= modulus <= PRIME:
        raise ValueError(f"modulus must be in [2, {PRIME}], got {modulus}")
    return modulus


def element_key(col: Column | str, modulus: int = PRIME) -> Column:
    """First 32 bits of md5(cast(col as string)) as a bigint, reduced mod ``modulus``."""
    c = F.col(col) if isinstance(col, str) else col
    hexed = F.substring(F.md5(c.cast("string")), 1, 8)
    return F.pmod(F.conv(hexed, 16, 10).cast("long"), F.lit(check_modulus(modulus)))


def element_key_sql(expr: str) -> str:
    """The same key in DuckDB SQL (used by the oracles)."""
    return f"((('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8))::BIGINT) % {PRIME})"


def canonical_pair(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    """(least, greatest) of two ids: an unordered pair with a stable key."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.least(ca, cb), F.greatest(ca, cb)


@dataclass(frozen=True)
class HashFamily:
    """``n`` linear hashes ``(a_i*x + b_i) % P`` fixed by ``seed``.

    Parameter arrays are emitted as one SQL literal expression each, so the
    driver builds a plan with a single parse instead of one JVM call per value.
    """

    n: int
    seed: int = 42
    prime: int = PRIME

    @property
    def params(self) -> list[tuple[int, int]]:
        return _params(self.n, self.seed, self.prime)

    def params_sql(self) -> str:
        """``array(named_struct('i', 0, 'a', ..L, 'b', ..L), ...)``: one struct per hash."""
        items = ", ".join(f"named_struct('i', {i}, 'a', {a}L, 'b', {b}L)" for i, (a, b) in enumerate(self.params))
        return f"array({items})"

    def banded_params_sql(self, bands: int, rows: int) -> str:
        """``array(named_struct('band', k, 'a0', .., 'b0', .., ...), ...)``: hash
        ``band*rows + r`` supplies ``a{r}, b{r}``."""
        if bands * rows > self.n:
            raise ValueError(f"{bands} bands x {rows} rows needs {bands * rows} hashes, family has {self.n}")
        ps = self.params
        structs = []
        for band in range(bands):
            fields = [f"'band', {band}"]
            for r in range(rows):
                a, b = ps[band * rows + r]
                fields.append(f"'a{r}', {a}L, 'b{r}', {b}L")
            structs.append(f"named_struct({', '.join(fields)})")
        return f"array({', '.join(structs)})"

    def values_sql(self) -> str:
        """``VALUES (i, a, b), ...`` rows for SQL oracles."""
        return ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(self.params))


@lru_cache(maxsize=64)
def _params(n: int, seed: int, prime: int) -> list[tuple[int, int]]:
    rng = random.Random(seed)
    return [(rng.randint(1, prime - 1), rng.randint(1, prime - 1)) for _ in range(n)]
