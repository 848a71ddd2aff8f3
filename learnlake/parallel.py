"""Running independent writes side by side and keeping one failure from stopping the others."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

WRITERS = 5


def each(work: Mapping[str, Callable[[], object]], width: int = WRITERS) -> dict:
    """Results by name; a few pieces of work run at a time so that small Spark jobs overlap."""
    with ThreadPoolExecutor(width) as pool:
        return dict(zip(work, pool.map(lambda run: run(), work.values())))


def attempt(write: Callable[[], object], park: Callable[[], object], attempts: int = 3) -> tuple[str, str | None]:
    """Run a write; after ``attempts`` failures run ``park`` instead. Returns status and last error."""
    error = None
    for _ in range(attempts):
        try:
            write()
            return "ok", None
        except Exception as exc:  # noqa: BLE001 - a failed target is reported, the rest goes on
            error = f"{type(exc).__name__}: {exc}"
    park()
    return "failed", error
