"""Argument checks shared by the operators (messages match what callers test for)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame


def require_dataframe(df: Any, message: str = "df must be a DataFrame") -> None:
    if df is None or not isinstance(df, DataFrame):
        raise TypeError(message)


def require_str(value: Any, message: str) -> None:
    if value is None or not isinstance(value, str):
        raise TypeError(message)


def require_bool(value: Any, name: str) -> None:
    if not isinstance(value, bool):
        msg = f"{name} must be a boolean"
        raise TypeError(msg)


def require_named_dataframes(**frames: Any) -> None:
    for name, frame in frames.items():
        if not isinstance(frame, DataFrame):
            msg = f"Expected DataFrame for {name}, got {type(frame).__name__} instead."
            raise TypeError(msg)


def require_optional_dataframe(frame: Any, name: str) -> None:
    if frame is not None and not isinstance(frame, DataFrame):
        msg = f"Expected DataFrame or None for {name}, got {type(frame).__name__} instead."
        raise TypeError(msg)
