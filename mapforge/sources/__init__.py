"""Where elements come from."""
