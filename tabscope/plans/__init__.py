"""What to profile: table and column specifications."""
