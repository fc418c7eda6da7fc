"""Reuse one derived DataFrame per source DataFrame.

The unit lists and the register views feed several branches of a report.
Returning the *same* DataFrame object to every branch keeps the driver from
rebuilding (and re-analysing) them, and gives Catalyst identical subplans,
whose shuffles AQE then computes once.
"""

from __future__ import annotations

import functools
from weakref import WeakKeyDictionary

_CACHE: WeakKeyDictionary = WeakKeyDictionary()


def per_source(fn):
    """Memoize ``fn(df, *args)`` on the identity of ``df`` (and the args)."""
    @functools.wraps(fn)
    def wrapped(df, *args):
        slot = _CACHE.setdefault(df, {})
        key = (fn.__qualname__, args)
        if key not in slot:
            slot[key] = fn(df, *args)
        return slot[key]
    return wrapped
