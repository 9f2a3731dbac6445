"""How plans are cut and stored."""
