"""What a run has to say, as events in order: shown while it runs, and kept for its report, log file and manifest."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import TextIO

LEVELS = ("step", "info", "success", "warning", "error")
_PROBLEMS = ("warning", "error")


@dataclass(frozen=True)
class Event:
    at: datetime
    level: str
    module: str
    message: str
    detail: str = ""

    def line(self) -> str:
        return f"{self.at:%H:%M:%S} {self.level:<7} {self.module}: {self.message}" + (f"\n    {self.detail}" if self.detail else "")


class EventLog:
    """Events of a process. A stage notes where the log stands (mark) and later takes its own part (since)."""

    def __init__(self, stream: TextIO | None = None, quiet: bool = True) -> None:
        self.events: list[Event] = []
        self.stream, self.quiet = stream, quiet

    def add(self, level: str, module: str, message: str, detail: str = "") -> Event:
        if level not in LEVELS:
            raise ValueError(f"level {level!r} is none of {', '.join(LEVELS)}")
        event = Event(datetime.now(UTC), level, module, message, detail)
        self.events.append(event)
        if not self.quiet or level in _PROBLEMS and self.stream:
            print(event.line(), file=self.stream or sys.stderr)
        return event

    def step(self, module: str, message: str, detail: str = "") -> Event:
        return self.add("step", module, message, detail)

    def info(self, module: str, message: str, detail: str = "") -> Event:
        return self.add("info", module, message, detail)

    def success(self, module: str, message: str, detail: str = "") -> Event:
        return self.add("success", module, message, detail)

    def warn(self, module: str, message: str, detail: str = "") -> Event:
        return self.add("warning", module, message, detail)

    def error(self, module: str, message: str, detail: str = "") -> Event:
        return self.add("error", module, message, detail)

    def mark(self) -> int:
        return len(self.events)

    def since(self, mark: int) -> list[Event]:
        return self.events[mark:]


def told(events: Sequence[Event], level: str) -> list[str]:
    """Messages of a level, each once, in order; with their number where they came more than once."""
    counts = Counter(f"{e.module}: {e.message}" for e in events if e.level == level)
    return [m if n == 1 else f"{m} ({n} times)" for m, n in counts.items()]


def summary(events: Sequence[Event]) -> dict:
    seconds = (events[-1].at - events[0].at).total_seconds() if events else 0.0
    return {"seconds": round(seconds, 3), "warnings": sum(e.level == "warning" for e in events), "errors": sum(e.level == "error" for e in events), "problems": told(events, "error") + told(events, "warning")}


def text(events: Sequence[Event]) -> str:
    """The log file of a run."""
    return "".join(e.line() + "\n" for e in events)


#: The log of this process.
log = EventLog()
