"""Column expressions: distances, ring keys, grid cells and curve keys."""
