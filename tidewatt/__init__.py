"""Half-hourly electricity-market analytics expressed as Spark DataFrame jobs."""

from tidewatt.params import Params
from tidewatt.session import configure

__all__ = ["Params", "configure"]
