"""Streaming of the market-research library."""
