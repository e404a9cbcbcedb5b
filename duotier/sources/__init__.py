"""Input adapters over the given tables, and table sinks."""
