"""Operators of a training-data pipeline. Nothing outside this folder imports it, but for the entry module's guard."""
