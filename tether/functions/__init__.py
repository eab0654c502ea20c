"""Column functions: plain expressions over strings and arrays, no joins."""
