"""marketpulse.operators."""
