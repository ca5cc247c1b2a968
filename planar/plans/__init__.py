"""Planning helpers: multi-level grid and session settings."""
