"""Profile levels, write-back, registration and dictionary operators."""
