"""State that a Python worker keeps from task to task."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable


def kept(name: str, make: Callable[[], object]):
    """The worker's object of that name, made on first use.

    Functions travel by value, so their own module's variables start anew in each task.
    """
    module = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker"))
    if not hasattr(module, name):
        setattr(module, name, make())
    return getattr(module, name)
