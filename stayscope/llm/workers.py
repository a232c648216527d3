"""What Python workers remember from one task to the next.

Spark hands a worker from stage to stage. What an operator keeps there for its own later tasks
would stay while others work, so a stage that needs none of it has it given back first.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_kept: dict[str, Callable[[], None]] = {}


def remembers(name: str, clear: Callable[[], None]) -> None:
    """From now on this worker holds something for the operator ``name``."""
    _kept[name] = clear


def forget_others(name: str) -> None:
    """Give back what this worker holds for operators other than ``name``."""
    others = [other for other in _kept if other != name]
    for other in others:
        _kept.pop(other)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)
