"""Physical building blocks: written cuts, hot-key joins and packed tiles."""
