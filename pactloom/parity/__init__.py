"""Every operator as a query over the test tables, next to the SQL that must agree with it."""

from __future__ import annotations

from pactloom.parity import functions, gate, ingest, mart, quality, staging, streams
from pactloom.parity.case import Case

CASES: dict[str, Case] = {
    c.name: c for module in (staging, quality, mart, ingest, functions, gate, streams) for c in module.CASES
}

__all__ = ["CASES", "Case"]
