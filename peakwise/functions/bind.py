from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Catalyst may inline a projected column into the lambda of a higher-order function, where
    it would run once per array element.  A lambda variable cannot be inlined.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
