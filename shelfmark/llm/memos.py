"""Memos that worker processes keep from task to task, held for one operator at a time.

Spark uses a Python worker again for the tasks of later stages. What an operator remembered there
would stay beside the memos of all operators after it, so the first use by another one empties it.
"""

from __future__ import annotations

from collections.abc import Callable

_kept: dict[str, Callable[[], None]] = {}
_user: list[str] = []


def keep(owner: str, empty: Callable[[], None]) -> None:
    """Tell how the memos of an operator are emptied."""
    _kept[owner] = empty


def claim(owner: str) -> None:
    """Empty the memos of all operators but this one, unless it was the last to ask."""
    if _user != [owner]:
        for other, empty in _kept.items():
            if other != owner:
                empty()
        _user[:] = [owner]
