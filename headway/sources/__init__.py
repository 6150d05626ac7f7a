"""Table readers, writers and generators."""
