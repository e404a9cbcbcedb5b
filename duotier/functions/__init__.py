"""Column-level helpers (tokens, JSON fields, exact ratios, fixed-digit text)."""
