"""What a Python worker keeps between tasks, of one operator at a time.

Spark uses a worker again for any operator's tasks.  Caches are kept under
the operator's name and dropped, with the memory Arrow holds in reserve, when
another operator begins, so a worker never holds two operators' caches.  A
task that is still running has its own reference and is not disturbed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")
_KEPT: dict[Hashable, object] = {}
POWERS: dict = {}               # tables of strata.llm.words
_OWNER = [""]
try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):    # not glibc, which alone keeps what numpy has freed
    _TRIM = None


def give_back() -> None:
    """Return freed memory, Arrow's and numpy's, to the machine."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def begin(operator: str) -> None:
    """Drop what other operators left in this worker."""
    if _OWNER[0] != operator:
        _OWNER[0] = operator
        _KEPT.clear()
        POWERS.clear()
        give_back()


def kept(operator: str, key: Hashable, make: Callable[[], T]) -> T:
    """The operator's value for ``key``, made where it isn't there."""
    begin(operator)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]       # type: ignore[return-value]
