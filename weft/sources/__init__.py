"""sources of weft."""
