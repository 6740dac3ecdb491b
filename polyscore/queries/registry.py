"""Query registry used by ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from polyscore.queries.oracle import with_fx

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` with an optional oracle body.

    ``sql`` may name fixture views ``fx_*``; their definitions are
    prepended as CTEs so DuckDB sees only the driver tables.
    """
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, with_fx(sql) if sql else None)
        return fn
    return deco


def load_all() -> dict[str, tuple[Callable, str | None]]:
    import polyscore.queries.q_basic  # noqa: F401
    import polyscore.queries.q_score  # noqa: F401
    import polyscore.queries.q_relational  # noqa: F401
    import polyscore.queries.q_export  # noqa: F401
    import polyscore.queries.q_clump  # noqa: F401
    import polyscore.queries.q_eval  # noqa: F401
    import polyscore.queries.q_more  # noqa: F401
    return REGISTRY
