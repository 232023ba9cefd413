"""Structured Streaming jobs and the keyed state behind them."""
