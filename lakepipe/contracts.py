"""Contracts and rule sets as typed driver-side configuration.

These objects are small configuration (a handful of properties and rules);
they never hold data rows.  They are compiled into Spark ``Column``s by the
operators.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache
from pathlib import Path
from typing import Any

import yaml

RESOURCES = Path(__file__).parent / "resources"

RULE_TYPES = ("not_null", "accepted_values", "range", "unique",
              "aggregate_expression", "row_expression")


@dataclass(frozen=True)
class Rule:
    id: str
    stage: str
    dimension: str
    type: str
    severity: str
    columns: tuple[str, ...] = ()
    column: str | None = None
    values: tuple[Any, ...] = ()
    min: Any = None
    max: Any = None
    expression: str | None = None
    description: str | None = None
    ignore_null: bool = False       # accepted_values: leave NULLs to other rules

    @property
    def blocking(self) -> bool:
        return self.severity == "blocking"


@dataclass(frozen=True)
class RuleSet:
    contract: str
    version: str
    rules: tuple[Rule, ...]

    def for_stage(self, stage: str | None) -> "RuleSet":
        if stage is None:
            return self
        return RuleSet(self.contract, self.version,
                       tuple(r for r in self.rules if r.stage == stage))

    def only(self, *ids: str) -> "RuleSet":
        return RuleSet(self.contract, self.version,
                       tuple(r for r in self.rules if r.id in ids))


@dataclass(frozen=True)
class Property:
    name: str
    logical_type: str
    required: bool = False
    pattern: str | None = None
    code_list: str | None = None
    minimum: Any = None


@dataclass(frozen=True)
class Contract:
    id: str
    version: str
    return_type: str
    properties: tuple[Property, ...]
    name_pattern: str
    deadline_days: int
    retention: dict = field(default_factory=dict)
    freshness_hours: int = 4

    @property
    def column_names(self) -> list[str]:
        return [p.name for p in self.properties]


def _rule(d: dict) -> Rule:
    t = d["type"]
    if t not in RULE_TYPES:
        raise ValueError(f"Unknown rule type: {t}")
    return Rule(id=d["id"], stage=d["stage"], dimension=d["dimension"], type=t,
                severity=d["severity"], columns=tuple(d.get("columns", ())),
                column=d.get("column"), values=tuple(d.get("values", ())),
                min=d.get("min"), max=d.get("max"), expression=d.get("expression"),
                description=d.get("description"))


def rules_from_dict(spec: dict) -> RuleSet:
    return RuleSet(spec["contract"], str(spec["version"]),
                   tuple(_rule(r) for r in spec["rules"]))


@lru_cache(maxsize=None)
def load_rules(contract: str, path: str | None = None) -> RuleSet:
    p = Path(path) if path else RESOURCES / "rules" / f"{contract}.yaml"
    return rules_from_dict(yaml.safe_load(p.read_text()))


@lru_cache(maxsize=None)
def load_contract(name: str = "lcr-monthly.v1", path: str | None = None) -> Contract:
    p = Path(path) if path else RESOURCES / "contracts" / f"{name}.yaml"
    d = yaml.safe_load(p.read_text())
    props = tuple(Property(name=x["name"], logical_type=x["logicalType"],
                           required=bool(x.get("required", False)),
                           pattern=x.get("pattern"), code_list=x.get("codeList"),
                           minimum=x.get("minimum"))
                  for x in d["properties"])
    return Contract(id=d["id"], version=str(d["version"]), return_type=d["return_type"],
                    properties=props, name_pattern=d["file"]["name_pattern"],
                    deadline_days=int(d["deadline_days_after_period_end"]),
                    retention=dict(d.get("retention", {})),
                    freshness_hours=int(d.get("freshness_hours", 4)))


@lru_cache(maxsize=None)
def load_event_contract(name: str = "payments-events.v1") -> dict:
    return yaml.safe_load((RESOURCES / "contracts" / f"{name}.yaml").read_text())
