"""Dataset writes and catalog registration."""
