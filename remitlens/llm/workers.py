"""What one Python worker keeps between its tasks (vocabularies, caches)."""

from __future__ import annotations

import sys
import types


def kept(key, make):
    """``make()``'s result, made once per worker process and key.

    Operators are shipped to the workers by value, so a module global would be
    made anew for every task; a module registered in ``sys.modules`` stays."""
    store = sys.modules.setdefault("remitlens_worker_store", types.ModuleType("remitlens_worker_store")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]
