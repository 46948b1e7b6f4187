"""Whole jobs: the daily forecast run and the scorecard."""
