"""What a user picks before running a query."""

from __future__ import annotations

from dataclasses import dataclass

from tradewind.functions.codes import build_code_patterns


@dataclass(frozen=True)
class QuerySpec:
    """Selections for one query; ``None`` means "All" (everything the lookup lists, every month there is)."""

    start: str | None = None                    # first month, yyyy-MM
    end: str | None = None                      # last month, yyyy-MM
    codes2: tuple[str, ...] | None = None
    codes4: tuple[str, ...] | None = None
    codes6: tuple[str, ...] | None = None
    codes8: tuple[str, ...] | None = None
    countries: tuple[str, ...] | None = None    # names
    ports: tuple[str, ...] | None = None        # names, ignored on the EU side
    keep_unknown: bool = False                  # keep NULL countries and blank ports

    @property
    def patterns(self) -> list[str]:
        return build_code_patterns(self.codes2, self.codes4, self.codes6, self.codes8)
