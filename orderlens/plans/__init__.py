"""Composed jobs: feature build, models, backtests, explanations."""
