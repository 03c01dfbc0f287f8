"""Prompt templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomfeed.functions.text import has_input, text_of

# Text printed for a missing cell.
NULL_TEXT = "None"


def _line(label: str, name: str, null_text: str) -> Column:
    return F.concat(F.lit(f"{label}: "), text_of(name, null_text))


def prompt_full(df: DataFrame, out: str = "prompt", null_text: str = NULL_TEXT) -> DataFrame:
    """First-generation template: all three lines, always."""
    lines = [
        _line("Instruction", "instruction", null_text),
        _line("Input", "input", null_text),
        _line("Output", "output", null_text),
    ]
    return df.withColumn(out, F.concat_ws("\n", *lines))


def prompt_optional_input(
    df: DataFrame, out: str = "prompt", null_text: str = NULL_TEXT
) -> DataFrame:
    """Second-generation template: no input line where there is no input."""
    # concat_ws leaves a null part out together with its separator
    lines = [
        _line("Instruction", "instruction", null_text),
        F.when(has_input("input"), _line("Input", "input", null_text)),
        _line("Output", "output", null_text),
    ]
    return df.withColumn(out, F.concat_ws("\n", *lines))
