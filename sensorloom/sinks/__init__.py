"""Where scored readings go."""
