"""The library on the executors, see ``gristmill.shipping``."""

from __future__ import annotations

from gristmill.shipping import ship

__all__ = ["ship"]
