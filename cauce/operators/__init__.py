"""DataFrame operators. Every function takes and returns a lazy DataFrame."""
