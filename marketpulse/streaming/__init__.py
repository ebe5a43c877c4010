"""marketpulse.streaming."""
