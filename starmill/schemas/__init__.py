"""Fixed source schemas: columns, keys, references, checks and defaults."""
