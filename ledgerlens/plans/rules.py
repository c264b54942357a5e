"""Rules as data: an ordered set of named segments, each of conditions joined by AND or OR, stored as JSON."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, replace
from pathlib import Path
from typing import Any

#: The operators of the rule format, by the kind of column they are meant for.
NUMERIC_OPS = ("==", "!=", ">", ">=", "<", "<=", "between", "est vide", "n'est pas vide")
TEXT_OPS = ("==", "!=", "contient", "ne contient pas", "commence par", "finit par", "dans la liste", "pas dans la liste", "regex", "est vide", "n'est pas vide")
DATE_OPS = NUMERIC_OPS
OPERATORS = frozenset(NUMERIC_OPS + TEXT_OPS)
#: English names that may be used for the operators.
ALIASES = {
    "contains": "contient", "not contains": "ne contient pas", "starts with": "commence par", "ends with": "finit par",
    "in": "dans la liste", "not in": "pas dans la liste", "is empty": "est vide", "is not empty": "n'est pas vide",
}


class RuleError(ValueError):
    """A rule that can't be read or compiled."""


@dataclass(frozen=True)
class Condition:
    column: str
    op: str
    value: Any = ""


@dataclass(frozen=True)
class Segment:
    name: str
    logic: str = "AND"
    conditions: tuple[Condition, ...] = ()


def _condition(x: Any) -> Condition:
    if not isinstance(x, dict) or not isinstance(x.get("column"), str) or not isinstance(x.get("op"), str):
        raise RuleError(f"not a condition: {x!r}")
    value = x.get("value")
    if isinstance(value, dict):
        raise RuleError(f"not a value: {value!r}")
    return Condition(x["column"], x["op"], tuple(value) if isinstance(value, list) else value)


@dataclass(frozen=True)
class RuleSet:
    """Immutable; every change gives a new rule set. The first segment that matches a row takes it."""

    segments: tuple[Segment, ...] = ()

    def _with(self, i: int, **change: Any) -> "RuleSet":
        if not 0 <= i < len(self.segments):
            raise RuleError(f"no segment {i}")
        return RuleSet(self.segments[:i] + (replace(self.segments[i], **change),) + self.segments[i + 1 :])

    def add(self, name: str) -> "RuleSet":
        if not name.strip():
            raise RuleError("a segment needs a name")
        return RuleSet((*self.segments, Segment(name.strip())))

    def rename(self, i: int, name: str) -> "RuleSet":
        if not name.strip():
            raise RuleError("a segment needs a name")
        return self._with(i, name=name.strip())

    def move(self, i: int, by: int) -> "RuleSet":
        """Up (-1) or down (+1); at the end of the list it stays."""
        j = i + by
        if not (0 <= i < len(self.segments) and 0 <= j < len(self.segments)):
            return self
        s = list(self.segments)
        s.insert(j, s.pop(i))
        return RuleSet(tuple(s))

    def set_logic(self, i: int, logic: str) -> "RuleSet":
        if logic not in ("AND", "OR"):
            raise RuleError(f"no logic {logic!r}")
        return self._with(i, logic=logic)

    def remove(self, i: int) -> "RuleSet":
        self._with(i)
        return RuleSet(self.segments[:i] + self.segments[i + 1 :])

    def add_condition(self, i: int, column: str, op: str = "==", value: Any = "") -> "RuleSet":
        s = self._with(i).segments[i]
        return self._with(i, conditions=(*s.conditions, Condition(column, op, value)))

    def set_condition(self, i: int, k: int, **change: Any) -> "RuleSet":
        c = self._with(i).segments[i].conditions
        if not 0 <= k < len(c):
            raise RuleError(f"no condition {k}")
        return self._with(i, conditions=c[:k] + (replace(c[k], **change),) + c[k + 1 :])

    def remove_condition(self, i: int, k: int) -> "RuleSet":
        c = self._with(i).segments[i].conditions
        if not 0 <= k < len(c):
            raise RuleError(f"no condition {k}")
        return self._with(i, conditions=c[:k] + c[k + 1 :])

    def clear(self) -> "RuleSet":
        return RuleSet()

    def to_json(self) -> str:
        rows = [{"name": s.name, "logic": s.logic, "conditions": [{"column": c.column, "op": c.op, "value": list(c.value) if isinstance(c.value, tuple) else c.value} for c in s.conditions]} for s in self.segments]
        return json.dumps(rows, ensure_ascii=False, indent=2)

    @staticmethod
    def from_json(text: str) -> "RuleSet":
        """A missing logic is AND. Raises RuleError for what isn't a rule set."""
        try:
            rows = json.loads(text)
        except ValueError as e:
            raise RuleError(f"not JSON: {e}") from e
        if not isinstance(rows, list):
            raise RuleError("a rule set is a list")
        out = []
        for r in rows:
            if not isinstance(r, dict) or not isinstance(r.get("name"), str) or not isinstance(r.get("conditions", []), list):
                raise RuleError(f"not a segment: {r!r}")
            out.append(Segment(r["name"], str(r.get("logic", "AND")), tuple(map(_condition, r.get("conditions", [])))))
        return RuleSet(tuple(out))


class RuleStore:
    """A rule set in a file, replaced as a whole. A missing or unreadable file is an empty rule set."""

    def __init__(self, path: str | Path) -> None:
        self.path = Path(path)

    def load(self) -> RuleSet:
        try:
            return RuleSet.from_json(self.path.read_text(encoding="utf-8"))
        except (OSError, UnicodeError, RuleError):
            return RuleSet()

    def save(self, rules: RuleSet) -> None:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        part = self.path.with_name(self.path.name + ".part")
        part.write_text(rules.to_json(), encoding="utf-8")
        os.replace(part, self.path)

    def import_json(self, text: str) -> RuleSet:
        """Replaces the stored rules; what can't be read changes nothing."""
        rules = RuleSet.from_json(text)
        self.save(rules)
        return rules
