"""From inputs to results: batch, stream, and whole jobs."""
