"""marketpulse.sources."""
