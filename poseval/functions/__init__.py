"""Column expressions: Column in, Column out, no shuffle and no action."""
