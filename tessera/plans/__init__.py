"""Named queries over the tables."""
