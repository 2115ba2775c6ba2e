"""Table sources."""
