"""Versioned rule sets: label dictionaries and drop rules are data.

A rule set has
* ``labels``: ordered mapping label -> case-insensitive regex (priority
  order, used by first-match categorisation);
* ``drop_exact``: case-sensitive exact term set;
* ``drop_regex``: case-insensitive regex, searched anywhere in a term;
* ``fallback``: category name for a term that no label matches.

The wide ``y_*`` columns are always emitted in sorted label order.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RuleSet:
    name: str
    labels: dict[str, str]
    drop_exact: tuple[str, ...] = ()
    drop_regex: str | None = None
    fallback: str = "other"
    distinct_terms: bool = False  # v1 keeps first occurrence only
    meta: dict = field(default_factory=dict)

    @property
    def sorted_labels(self) -> list[str]:
        return sorted(self.labels)

    @property
    def y_cols(self) -> list[str]:
        return [f"y_{lab}" for lab in self.sorted_labels]


def get(name: str) -> RuleSet:
    from . import adverse, families, parts
    table = {f.name: f for f in families.FAMILIES} | {"parts": parts.PARTS, "adverse_v1": adverse.ADVERSE_V1, "adverse_v2": adverse.ADVERSE_V2}
    return table[name]
