"""Where readings come from."""
