"""Session settings that hold for a block only."""

from __future__ import annotations

from contextlib import contextmanager


@contextmanager
def settings(spark, values):
    earlier = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in earlier.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
