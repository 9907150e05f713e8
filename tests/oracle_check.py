"""Compare a Spark result with the answer of DuckDB: columns, types and all values, in any row order."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if pd.api.types.is_float_dtype(frame[name]):
            # -0.0 and 0.0 are the same value.
            frame[name] = frame[name] + 0.0
        elif not pd.api.types.is_numeric_dtype(frame[name]):
            frame[name] = frame[name].map(lambda v: None if pd.isna(v) else str(v))
    return frame.sort_values(list(frame.columns), kind="stable").reset_index(drop=True)


def _kind(data_type: str) -> str:
    names = {
        "varchar": "string", "integer": "int", "timestamp_ntz": "timestamp", "float64": "double",
    }
    return names.get(data_type.lower(), data_type.lower())


def differences(result, connection, sql: str) -> list[str]:
    """What is wrong with the Spark result, or nothing."""
    relation = connection.sql(sql)
    spark_types = {f.name: _kind(f.dataType.simpleString()) for f in result.schema.fields}
    duck_types = {n: _kind(str(t)) for n, t in zip(relation.columns, relation.types)}
    problems = []
    if spark_types != duck_types:
        wrong = sorted(set(spark_types.items()) ^ set(duck_types.items()))
        problems.append(f"schema differs: {wrong}")
        if set(spark_types) != set(duck_types):
            return problems
    ours, theirs = _plain(result.toPandas()), _plain(relation.df())
    if len(ours) != len(theirs):
        return [*problems, f"{len(ours)} rows, expected {len(theirs)}"]
    if len(ours) == 0:
        problems.append("no rows to compare")
    for name in ours.columns:
        same = (ours[name] == theirs[name]) | (ours[name].isna() & theirs[name].isna())
        if not same.all():
            at = same[~same].index[0]
            problems.append(
                f"{name}: {int((~same).sum())} values differ, first {ours[name][at]!r} != {theirs[name][at]!r}"
            )
    return problems
