"""Reproducible random numbers keyed on row identity.

Values depend only on the seed and the key columns, so they are the same for every partitioning, retry and
engine that has md5.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions.digest import as_lists, draw_uniforms, uniforms

HEX_DIGITS = 13
SCALE = float(2**52)


def uniform(seed: object, *keys: str | Column) -> Column:
    """A uniform in [0, 1) from 52 bits of md5 over ``seed|key|...``."""
    parts = [F.lit(str(seed))] + [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint") / F.lit(SCALE)


def uniform_sql(seed: object, *keys: str) -> str:
    """DuckDB text of :func:`uniform`."""
    joined = ", ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"(CAST(concat('0x', substr(md5(concat_ws('|', {joined})), 1, {HEX_DIGITS})) AS BIGINT) / pow(2, 52))"


def normal(seed: object, *keys: str | Column) -> Column:
    """A standard normal by Box-Muller from two keyed uniforms."""
    u1 = uniform(f"{seed}a", *keys) + F.lit(2.0**-53)
    u2 = uniform(f"{seed}b", *keys)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)


def normal_sql(seed: object, *keys: str) -> str:
    u1 = f"({uniform_sql(f'{seed}a', *keys)} + pow(2, -53))"
    u2 = uniform_sql(f"{seed}b", *keys)
    return f"(sqrt(-2.0 * ln({u1})) * cos(6.283185307179586 * {u2}))"


# ---------------------------------------------------------------- all draws of a key at once


def key_text(key: str | Column) -> Column:
    """A key with the separator before it; a missing one leaves no trace, as in :func:`uniform`."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.coalesce(F.concat(F.lit("|"), text), F.lit(""))


def uniform_draws(seed: object, draws: int, key: str | Column) -> Column:
    """``uniform(seed, draw, key)`` of draws 1..n as an array, hashed in one go."""
    seed = str(seed)

    @F.arrow_udf("array<double>")
    def made(k: pa.Array) -> pa.Array:
        return as_lists(draw_uniforms(k, seed, draws))

    return made(key_text(key))


def seeded_uniforms(seeds: Sequence[object], key: str | Column) -> Column:
    """``uniform(seed, key)`` of several seeds as an array, hashed in one go; a key that a batch repeats is hashed once."""
    names = [str(s) for s in seeds]

    @F.arrow_udf("array<double>")
    def made(k: pa.Array) -> pa.Array:
        coded = k.dictionary_encode()
        return as_lists(uniforms(coded.dictionary, names, [""] * len(names))[coded.indices.to_numpy(zero_copy_only=False)])

    return made(key_text(key))


def normal_matrix(keys: pa.Array, seed: str, draws: int) -> np.ndarray:
    """``normal(seed, draw, key)`` of draws 1..n, shape (keys, draws); keys bring the separator before them."""
    coded = keys.dictionary_encode()
    u1, u2 = draw_uniforms(coded.dictionary, f"{seed}a", draws), draw_uniforms(coded.dictionary, f"{seed}b", draws)
    z = np.sqrt(-2.0 * np.log(u1 + 2.0**-53)) * np.cos(6.283185307179586 * u2)
    return z[coded.indices.to_numpy(zero_copy_only=False)]


def _normals(keys: pa.Array, seed: str, draws: int) -> pa.Array:
    return as_lists(normal_matrix(keys, seed, draws))


def normal_draws(seed: object, draws: int, key: str | Column) -> Column:
    """``normal(seed, draw, key)`` of draws 1..n as an array, hashed in one go."""
    seed = str(seed)

    @F.arrow_udf("array<double>")
    def made(k: pa.Array) -> pa.Array:
        return _normals(k, seed, draws)

    return made(key_text(key))


def with_normal_draws(df: DataFrame, draws: int, noise: dict[str, tuple[str, str]], limit: int = 1_000_000) -> DataFrame:
    """Several :func:`normal_draws` side by side, from seeds and key columns by name.

    Rows travel in slices of at most ``limit`` numbers, whatever the count of draws and columns.
    """
    keys = {c: f"__key{i}" for i, c in enumerate(dict.fromkeys(c for _, c in noise.values()))}
    df = df.withColumns({k: key_text(c) for c, k in keys.items()})
    kept = [c for c in df.columns if c not in keys.values()]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, T.ArrayType(T.DoubleType())) for n in noise])
    rows = max(1, limit // max(1, draws * len(noise)))

    def task(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                made = [_normals(part.column(keys[c]), seed, draws) for seed, c in noise.values()]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *made], names=[*kept, *noise])

    return df.mapInArrow(task, schema)


def bernoulli_array(seed: object, key: str | Column, chances: str | Column) -> Column:
    """``uniform(seed, draw, key) < chance`` as 0 or 1 for an array of chances, one per draw; null where the chance is."""
    seed = str(seed)

    @F.arrow_udf("array<int>")
    def made(k: pa.Array, p: pa.Array) -> pa.Array:
        counts = p.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        draws = int(counts.max(initial=0))
        u = draw_uniforms(k, seed, draws)[np.arange(draws) < counts[:, None]]
        flat = p.flatten()
        hit = u < flat.to_numpy(zero_copy_only=False)
        values = pa.array(hit.astype(np.int32), mask=flat.is_null().to_numpy(zero_copy_only=False))
        return pa.ListArray.from_arrays(np.concatenate([[0], counts.cumsum()]).astype(np.int32), values, mask=p.is_null())

    return made(key_text(key), chances)
