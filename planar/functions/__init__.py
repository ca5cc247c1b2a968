"""Column functions: geometry expressions and text renderings."""
