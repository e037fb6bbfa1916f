"""What one Python worker process keeps between its tasks."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import TypeVar

Kept = TypeVar("Kept")


def kept(key: tuple, make: Callable[[], Kept]) -> Kept:
    """The object made for ``key`` in this process, made at most once.

    Functions reach a worker as copies, so their modules' globals last for one task only; objects that
    are slow to make, a tokenizer for instance, are therefore kept at the interpreter.
    """
    store = vars(sys).setdefault("_tutorlake_llm", {})
    if key not in store:
        store[key] = make()
    return store[key]
