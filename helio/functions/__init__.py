"""Part of helio."""
