"""Indicators as calculated columns of a BI model, and as text for readers."""

from __future__ import annotations

from collections.abc import Sequence

from ..operators.candidates import Candidate


def clean_name(text: str) -> str:
    """A name without the characters that a model's names may not hold."""
    return " ".join(text.translate({ord(c): " " for c in "[]{}\"'`;\t\r\n"}).split()) or "Indicator"


def unique_names(names: Sequence[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for name in map(clean_name, names):
        seen[name.lower()] = seen.get(name.lower(), 0) + 1
        out.append(f"{name} ({seen[name.lower()]})" if seen[name.lower()] > 1 else name)
    return out


def quoted(text: str) -> str:
    return '"' + text.replace('"', '""') + '"'


def bi_script(candidates: Sequence[Candidate], names: Sequence[str], table: str) -> tuple[str, list[str]]:
    """A script that adds a calculated column per indicator, and the labels that have no formula."""
    lines, failed = [f"var table = Model.Tables[{quoted(table)}];"], []
    for c, name in zip(candidates, unique_names(names)):
        try:
            formula = c.to_dax(table)
        except (ValueError, IndexError, TypeError):
            formula = ""
        if not formula:
            failed.append(c.label())
            continue
        lines.append(f"table.AddCalculatedColumn({quoted(name)}, @{quoted(formula)});")
    return "\n".join(lines) + "\n", failed
