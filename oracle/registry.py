from __future__ import annotations

from oracle import documents, finance


def statements() -> dict[str, str]:
    return {**finance.statements(), **documents.statements()}
