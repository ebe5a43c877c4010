"""marketpulse.functions."""
