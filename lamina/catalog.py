"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and the SQL they must equal."""

from __future__ import annotations

from lamina.queries import artifacts, cases, fixtures, layout, topics

FLAGSHIP = "artifact_clean_text"
QUERIES = {**artifacts.QUERIES, **layout.QUERIES, **fixtures.QUERIES, **cases.QUERIES, **topics.QUERIES}
ORACLES: dict[str, str] = {**artifacts.ORACLES, **layout.ORACLES, **fixtures.ORACLES, **cases.ORACLES, **topics.ORACLES}
