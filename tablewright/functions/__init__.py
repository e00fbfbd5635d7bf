"""Column functions with the defined null, rounding and regex rules."""
