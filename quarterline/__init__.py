"""Quarterly company fundamentals, risk features, screens and backtests on Spark."""
