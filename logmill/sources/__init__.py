"""Where messages come from and where rows go."""
