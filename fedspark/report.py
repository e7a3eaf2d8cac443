"""What a query did before Spark ran it."""

from __future__ import annotations

import time
from dataclasses import dataclass, field


@dataclass
class Report:
    """Timed steps with details, as text or as a dictionary."""

    sql: str
    steps: list[dict] = field(default_factory=list)
    plan: str | None = None

    def step(self, name: str, **details) -> None:
        self.steps.append({"step": name, "at": time.time(), "details": details})

    def to_dict(self) -> dict:
        return {"sql": self.sql, "steps": self.steps, "plan": self.plan}

    def text(self) -> str:
        lines = [f"Query: {self.sql}"]
        first = self.steps[0]["at"] if self.steps else 0.0
        for i, s in enumerate(self.steps, 1):
            said = ", ".join(f"{k}={v}" for k, v in s["details"].items())
            lines.append(f"{i}. {s['step']} (+{(s['at'] - first) * 1000:.1f} ms){': ' + said if said else ''}")
        if self.plan:
            lines += ["", self.plan]
        return "\n".join(lines)
