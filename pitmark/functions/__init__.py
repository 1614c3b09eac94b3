"""Functions of the market-research library."""
