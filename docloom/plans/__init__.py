"""Configuration and the whole batch plan."""
