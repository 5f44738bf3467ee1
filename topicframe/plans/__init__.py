"""The two consumers and the two publishers, end to end."""
