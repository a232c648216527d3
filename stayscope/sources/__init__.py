"""Files and message topics."""
