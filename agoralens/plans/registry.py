"""Named questions on the test tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Question = Callable[[SparkSession, str], DataFrame]

QUESTIONS: dict[str, Question] = {}
SQL: dict[str, str] = {}


def question(sql: str | None = None, name: str | None = None) -> Callable[[Question], Question]:
    def add(function: Question) -> Question:
        key = name or function.__name__
        if key in QUESTIONS:
            raise ValueError(f"question {key} is registered twice")
        QUESTIONS[key] = function
        if sql is not None:
            SQL[key] = sql
        return function

    return add


def load_all() -> None:
    """Import every module that registers questions."""
    from agoralens.plans import (  # noqa: F401
        defaults,
        forecasts,
        graphs,
        known_models,
        models,
        overview,
        sketches,
        sources,
        streams,
        texts,
        topic_models,
    )
