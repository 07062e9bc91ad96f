"""All registered queries and their SQL counterparts."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from engage.queries import attribution, ranges, reports, social, users
from engage.session import configure

QueryFn = Callable[[SparkSession, str], DataFrame]


def _configured(run: QueryFn) -> QueryFn:
    @functools.wraps(run)
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    return wrapped


_ALL = {**attribution.QUERIES, **users.QUERIES, **ranges.QUERIES, **social.QUERIES, **reports.QUERIES}
QUERIES: dict[str, QueryFn] = {name: _configured(run) for name, (run, _) in _ALL.items()}
ORACLE: dict[str, str] = {name: sql.strip() for name, (_, sql) in _ALL.items()}
