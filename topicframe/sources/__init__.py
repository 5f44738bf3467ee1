"""Topics as tables."""
