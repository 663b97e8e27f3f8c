"""Column expressions: type classes, text forms, value buckets, character patterns."""
