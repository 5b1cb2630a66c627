"""Things that a Python worker keeps from one task to the next."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

_HOLDER = "_kept_by_worker"


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """What `make` gave for this key in this process, made once while no other key comes.

    Functions travel by value, so their own module has no lasting globals. One thing
    is kept at a time: a worker serves one operator after another.
    """
    holder = sys.modules.setdefault(_HOLDER, ModuleType(_HOLDER))
    if getattr(holder, "key", None) != key:
        holder.key = holder.value = None
        holder.value = make()
        holder.key = key
    return holder.value
