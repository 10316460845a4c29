"""Plan building blocks that keep every task bounded under skew."""
