"""Partition-independent randomness as column expressions.

``rand(seed)`` depends on how rows fall into partitions, so re-running a job
after an executor loss or with another partition count changes the draws.
Here every draw is a pure function of (row key, stream name, seed): the first
32 bits of ``md5(key:stream:seed)`` mapped to the open interval (0, 1).
The same formula is expressible in plain SQL, which makes generated data and
hash-based splits checkable against an independent engine.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _key(key: Column | str) -> Column:
    return (F.col(key) if isinstance(key, str) else key).cast("string")


def _bits_sql(key: str, stream: str, seed: int) -> str:
    return f"cast(conv(substring(md5(concat(cast(`{key}` as string), ':{stream}:{seed}')), 1, 8), 16, 10) as bigint)"


def _uniform_sql(key: str, stream: str, seed: int) -> str:
    return f"(({_bits_sql(key, stream, seed)} + 0.5D) / {TWO_POW_32}D)"


def _normal_sql(key: str, stream: str, seed: int) -> str:
    return (f"(sqrt(-2 * ln({_uniform_sql(key, stream + '_a', seed)}))"
            f" * cos({2.0 * math.pi!r}D * {_uniform_sql(key, stream + '_b', seed)}))")


# A key given by column name is drawn through one SQL expression (one call to
# the JVM instead of one per function); a key expression uses the Column API.
# Both build the same expression tree.

def hash_bits(key: Column | str, stream: str, seed: int = 42) -> Column:
    """Unsigned 32-bit integer from md5 of ``key:stream:seed`` (as bigint)."""
    if isinstance(key, str):
        return F.expr(_bits_sql(key, stream, seed))
    digest = F.md5(F.concat(_key(key), F.lit(f":{stream}:{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def uniform(key: Column | str, stream: str, seed: int = 42) -> Column:
    """U(0,1) draw, never exactly 0 or 1."""
    if isinstance(key, str):
        return F.expr(_uniform_sql(key, stream, seed))
    return (hash_bits(key, stream, seed) + F.lit(0.5)) / F.lit(TWO_POW_32)


def normal(key: Column | str, stream: str, seed: int = 42) -> Column:
    """N(0,1) draw by Box-Muller on two independent uniforms."""
    if isinstance(key, str):
        return F.expr(_normal_sql(key, stream, seed))
    u1 = uniform(key, f"{stream}_a", seed)
    u2 = uniform(key, f"{stream}_b", seed)
    return F.sqrt(F.lit(-2) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def gamma_2_5(key: Column | str, stream: str, seed: int = 42) -> Column:
    """Gamma(shape 2.5, scale 1): sum of two Exp(1) and half a chi-square(1)."""
    if isinstance(key, str):
        e1, e2 = _uniform_sql(key, f"{stream}1", seed), _uniform_sql(key, f"{stream}2", seed)
        z = _normal_sql(key, f"{stream}3", seed)
        return F.expr(f"(-ln({e1}) - ln({e2}) + power({z}, 2) / 2)")
    e1 = -F.log(uniform(key, f"{stream}1", seed))
    e2 = F.log(uniform(key, f"{stream}2", seed))
    z = normal(key, f"{stream}3", seed)
    return e1 - e2 + F.pow(z, 2) / F.lit(2)


def sql_uniform(key_sql: str, stream: str, seed: int = 42) -> str:
    """The same draw as :func:`uniform`, written for DuckDB."""
    return (f"((('0x'||substr(md5(({key_sql})::varchar||':{stream}:{seed}'),1,8))::bigint"
            f"+0.5::double)/4294967296.0::double)")


def sql_normal(key_sql: str, stream: str, seed: int = 42) -> str:
    return (f"(sqrt(-2*ln({sql_uniform(key_sql, stream + '_a', seed)}))"
            f"*cos(2*pi()*{sql_uniform(key_sql, stream + '_b', seed)}))")
