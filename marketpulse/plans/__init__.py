"""marketpulse.plans."""
