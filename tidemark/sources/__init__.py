"""Where lines and tokens come from."""
