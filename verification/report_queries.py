"""Whole report families. Their sections are compared one by one under the eda_ names."""

from __future__ import annotations

from marketlens.plans.reports import FAMILIES, report
from verification.registry import register

for _family in FAMILIES:
    register(f"report_{_family}", lambda m, f=_family: report(f, m))
