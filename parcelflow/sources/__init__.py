"""Where messages and rules come from."""
