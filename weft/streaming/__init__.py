"""streaming of weft."""
