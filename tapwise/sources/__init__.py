"""Input files, topics and stored tables."""
