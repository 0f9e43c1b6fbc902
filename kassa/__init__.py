"""Shop reporting jobs expressed as Spark DataFrame plans.

Every report is a function ``(shop, ..., as_of=...) -> DataFrame``: no action
runs inside a report except where a documented operator needs a small,
bounded summary (partition boundaries in :mod:`kassa.operators.sequence`).
"""

from kassa.session import configure, get_session

__all__ = ["configure", "get_session"]
