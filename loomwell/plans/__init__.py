"""Named queries and whole jobs."""
