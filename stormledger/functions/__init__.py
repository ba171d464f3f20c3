"""Column expressions: text, numbers, time, bands and planar geometry."""
