"""All checked queries, in registration order."""

from __future__ import annotations

from cardflow.registry import operator_checks, report_checks  # noqa: F401  (registers the checks)
from cardflow.registry.base import BUILDERS, ORACLES, Builder


def builders() -> dict[str, Builder]:
    return dict(BUILDERS)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
