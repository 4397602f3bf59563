"""Operators: cleaning, profiling, quantiles, rates, sampling and ML."""
