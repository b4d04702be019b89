"""operators of weft."""
