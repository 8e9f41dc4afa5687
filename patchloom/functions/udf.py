"""Pandas functions whose result type is given as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow_udf(result: str, once: bool = False) -> Callable:
    """Like pandas_udf, but the type is parsed when the function is used, so a
    module can be imported before there is a session. once: the optimizer neither
    moves filters below the column nor copies what is above it into them."""

    def wrap(fn: Callable) -> Callable[..., Column]:
        def call(*columns: Column | str) -> Column:
            made = F.pandas_udf(fn, result)
            return (made.asNondeterministic() if once else made)(*columns)

        return call

    return wrap
