"""Physical helpers and whole flows."""
