"""Where queries and their checking SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def add(name: str, run: Callable[[SparkSession, str], DataFrame], oracle: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = run
    if oracle is not None:
        ORACLES[name] = oracle


def query(name: str, oracle: str | None = None):
    def register(run):
        add(name, run, oracle)
        return run

    return register
