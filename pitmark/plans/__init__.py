"""Plans of the market-research library."""
