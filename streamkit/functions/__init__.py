"""Column-level building blocks: JSON decode/encode and schema handling."""
