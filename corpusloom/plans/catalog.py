"""All queries of the library and their SQL twins."""

from __future__ import annotations

from corpusloom.plans import base, q_campaign, q_dedup, q_decisions, q_files, q_intervals, q_planning, q_release, q_reports, q_signal, q_sources, q_streaming, q_text

_MODULES = (q_campaign, q_decisions, q_reports, q_intervals, q_dedup, q_planning, q_release, q_sources, q_text, q_signal, q_files, q_streaming)


def queries() -> dict:
    return dict(base.QUERIES)


def oracle_sql() -> dict:
    return dict(base.ORACLES)
