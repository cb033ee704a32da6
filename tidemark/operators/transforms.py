"""Named DataFrame -> DataFrame transforms.

A job without a transform passes its staging DataFrame through unchanged
(identity). A job that names a transform gets it from this registry; only an
unknown *explicit* name is an error.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame

from .event import encode_events

Transform = Callable[..., DataFrame]


def identity(df: DataFrame) -> DataFrame:
    return df


TRANSFORMS: dict[str, Transform] = {
    "identity": identity,
    # Staged rows per customer, or flat profile ⟕ orders rows -> encoded events.
    "customer_event": encode_events,
}


def register(name: str, fn: Transform) -> None:
    TRANSFORMS[name] = fn


def get_transform(name: str | None) -> Transform:
    if name is None:
        return identity
    try:
        return TRANSFORMS[name]
    except KeyError:
        raise KeyError(f"unknown transform {name!r}; known: {sorted(TRANSFORMS)}") from None


def apply_transform(df: DataFrame, name: str | None, **options) -> DataFrame:
    """Look the transform up and apply it with ``DataFrame.transform``.

    ``options`` are the run's values (e.g. ``event_time``); a transform gets
    those that it names as parameters.
    """
    fn = get_transform(name)
    wanted = {k: v for k, v in options.items() if k in inspect.signature(fn).parameters}
    return df.transform(fn, **wanted)
