"""Reuse of unresolved column expressions within one Spark application.

The rule set turns into several thousand Column objects; each one costs a
round trip to the JVM when built. Builders that only reference column
names (no DataFrame) are pure, so their result is kept per SparkContext and
shared by every plan that uses it. This only saves driver time; plans are
identical.
"""

from __future__ import annotations

import functools

from pyspark import SparkContext


def per_context(fn):
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        sc = SparkContext._active_spark_context
        key = (id(sc), sc.applicationId if sc is not None else None, args)
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]
    return wrapper
