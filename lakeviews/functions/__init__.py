"""Column-expression builders (coercion, exact rounding, text helpers)."""
