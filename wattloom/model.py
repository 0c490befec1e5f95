"""Shared vocabulary."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Family:
    """An accounting identity ``total = sum(parts)`` between columns."""

    total: str
    parts: tuple[str, ...]

    def __post_init__(self):
        object.__setattr__(self, "parts", tuple(self.parts))

    @property
    def columns(self) -> list[str]:
        return [self.total, *self.parts]
