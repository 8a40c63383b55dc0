"""Where records come from and results go."""
