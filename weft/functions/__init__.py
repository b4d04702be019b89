"""functions of weft."""
