"""Reuse of fixed column expressions within one Spark application.

Building a ``Column`` costs a Python -> JVM round trip per node; the label
chains, rules and casts of the trip layers are a few thousand nodes.  They
are unresolved expressions (resolved later against each plan), so one copy
per application serves every query.
"""

from __future__ import annotations

import functools
import inspect

_CACHE: dict = {}


def _application_key():
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    return None if sc is None else (id(sc), sc.applicationId)


def per_application(fn):
    """Memoise ``fn`` per running Spark application (arguments must be
    hashable and may be given by name).  Callers must not mutate the returned
    value."""
    signature = inspect.signature(fn)

    @functools.wraps(fn)
    def wrapper(*given, **named):
        bound = signature.bind(*given, **named)
        bound.apply_defaults()
        args = tuple(bound.arguments.values())
        app = _application_key()
        if app is None:
            return fn(*args)
        key = (app, fn.__module__, fn.__qualname__, args)
        hit = _CACHE.get(key)
        if hit is None:
            if len(_CACHE) > 4096:
                _CACHE.clear()
            hit = _CACHE[key] = fn(*args)
        return hit
    return wrapper
