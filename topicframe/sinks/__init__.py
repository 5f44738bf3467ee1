"""Tables the engine writes."""
