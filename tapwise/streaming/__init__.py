"""Live scoring of a message stream."""
