"""Whole plans: the analysis from frames to a time series, and its sinks."""
