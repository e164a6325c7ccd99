"""Tables on the way to a result: written to cut lineage, removed when the
result no longer reads them."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from cartwheel.plans import sink

_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`cartwheel.plans.sink.materialize`; inside :func:`passing` the
    table belongs to the innermost scope."""
    frame, path = sink.materialize(df, name)
    if _scopes.get():
        _scopes.get()[-1].append(path)
    return frame, path


@contextmanager
def passing(spark: SparkSession):
    """Removes the tables that are written inside at the end. The function that
    it gives keeps one: that table belongs to the scope around, if any."""
    own: list[str] = []
    kept: set[str] = set()
    token = _scopes.set((*_scopes.get(), own))
    try:
        yield kept.add
    finally:
        _scopes.reset(token)
        for path in own:
            if path in kept:
                if _scopes.get():
                    _scopes.get()[-1].append(path)
            else:
                sink.remove_path(spark, path)
