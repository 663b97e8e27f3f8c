"""Where tables come from and where profiles go."""
