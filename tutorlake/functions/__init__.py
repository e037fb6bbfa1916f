"""Column helpers. Everything here is a built-in expression, so plans stay in generated code."""
