"""Sources of the market-research library."""
