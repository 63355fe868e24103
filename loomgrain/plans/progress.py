"""Progress snapshots of driver-side loops, as one small JSON file."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from pathlib import Path

from loomgrain.operators.report import duration


class Progress:
    """Writes label, done, total, pct, rate, eta_s, elapsed_s, extra and updated, at most every two seconds; failures to write are ignored."""

    def __init__(self, label: str, total: int, path: str | Path | None = None, clock: Callable[[], float] = time.time, every: float = 2.0):
        self.label, self.total, self.path, self.clock, self.every = label, total, path and Path(path), clock, every
        self.began, self.last = clock(), float("-inf")

    def snapshot(self, done: int, extra: str = "") -> dict:
        spent = max(1e-9, self.clock() - self.began)
        rate = done / spent
        left = max(0, self.total - done)
        return {
            "label": self.label,
            "done": done,
            "total": self.total,
            "pct": round(100 * done / max(1, self.total), 2),
            "rate": rate,
            "eta_s": left / rate if rate else None,
            "elapsed_s": spent,
            "extra": extra,
            "updated": self.clock(),
        }

    def update(self, done: int, extra: str = "") -> None:
        now = self.clock()
        if now - self.last < self.every and done < self.total:
            return
        self.last = now
        if self.path:
            try:
                self.path.write_text(json.dumps(self.snapshot(done, extra)))
            except OSError:
                pass

    def line(self, done: int) -> str:
        s = self.snapshot(done)
        return f"{self.label} {done:,}/{self.total:,} in {duration(s['elapsed_s'])}"
