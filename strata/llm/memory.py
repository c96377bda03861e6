"""Memory that a Python worker no longer needs. Workers outlive their tasks, and what they hold counts for the next stage."""

from __future__ import annotations

import ctypes

import pyarrow as pa

try:
    _TRIM = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library, which gives memory back by its own rules
    _TRIM = None


def give_back() -> None:
    """Return free memory of Arrow and of the C library to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)
