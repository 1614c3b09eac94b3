"""Operators of the market-research library."""
