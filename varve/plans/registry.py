"""Transformers by source name."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from .. import constants as C
from ..operators.market import market_features
from ..operators.silver import bronze

_TRANSFORMERS: dict[str, Callable[..., DataFrame]] = {
    C.WEATHER_SOURCE: partial(bronze, source=C.WEATHER_SOURCE),
    C.MARKET_SOURCE: market_features,
}


def register(name: str, function: Callable[..., DataFrame]) -> None:
    _TRANSFORMERS[name.lower()] = function


def transformer(name: str) -> Callable[..., DataFrame]:
    try:
        return _TRANSFORMERS[name.lower()]
    except KeyError:
        known = ", ".join(sorted(_TRANSFORMERS))
        raise ValueError(f"unknown source: {name} (known: {known})") from None
