"""Parameters of a session analysis task."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields


def _present(value: object) -> str | None:
    """An empty parameter counts as absent."""
    text = None if value is None else str(value)
    return text or None


def _elements(value: str | None) -> tuple[str, ...] | None:
    return None if value is None else tuple(e for e in value.split(",") if e)


@dataclass(frozen=True)
class TaskParams:
    """Criteria of one task. ``None`` means: do not filter on this."""

    task_id: int | None = None
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[str, ...] | None = None

    @classmethod
    def from_values(cls, task_id: int | None = None, **values: object) -> TaskParams:
        """From text values by field name; the list fields take comma lists."""
        known = {f.name for f in fields(cls)} - {"task_id"}
        if unknown := set(values) - known:
            raise ValueError(f"unknown task parameters: {sorted(unknown)}")
        text = {name: _present(value) for name, value in values.items()}
        for name in ("start_age", "end_age"):
            if text.get(name) is not None:
                text[name] = int(text[name])
        for name in ("professionals", "cities", "keywords", "category_ids"):
            text[name] = _elements(text.get(name))
        return cls(task_id=task_id, **text)

    @classmethod
    def from_json(cls, text: str, task_id: int | None = None) -> TaskParams:
        """From a task's JSON object of arrays; the first element of each array counts.

        Raises ValueError for anything else.
        """
        raw = json.loads(text)
        if not isinstance(raw, dict):
            raise ValueError("task parameters are no JSON object")
        known = {field_of_key(key): value for key, value in raw.items()}
        known = {name: value for name, value in known.items() if name in _FIELDS}
        if wrong := [n for n, v in known.items() if not (v is None or isinstance(v, list))]:
            raise ValueError(f"task parameters that are no arrays: {wrong}")
        first = {name: value[0] for name, value in known.items() if value}
        return cls.from_values(task_id, **first)


def field_of_key(key: str) -> str:
    """``startDate`` to ``start_date``."""
    return "".join(f"_{ch.lower()}" if ch.isupper() else ch for ch in key)


_FIELDS = {f.name for f in fields(TaskParams)} - {"task_id"}
