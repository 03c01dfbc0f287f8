"""Instruction-tuning data preparation as Spark DataFrame transforms."""
