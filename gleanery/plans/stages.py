"""A registry of stages, run in order from any of them on."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass
class Plan:
    """Stages in order; those marked ``always`` run wherever a run starts."""

    stages: list[tuple[str, Callable[[dict], None], bool]] = field(default_factory=list)

    def stage(self, name: str, always: bool = False):
        def add(f: Callable[[dict], None]) -> Callable[[dict], None]:
            self.stages.append((name, f, always))
            return f

        return add

    def run(self, state: dict, start_from: str | None = None) -> list[str]:
        """Runs what is due over a shared state; returns the names that ran."""
        names = [n for n, _, _ in self.stages]
        if start_from is not None and start_from not in names:
            raise ValueError(f"no stage {start_from!r}; there are {', '.join(names)}")
        at = names.index(start_from) if start_from else 0
        ran = []
        for i, (name, f, always) in enumerate(self.stages):
            if i >= at or always:
                f(state)
                ran.append(name)
        return ran
