"""The user-level queries."""
