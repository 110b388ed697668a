"""Column-level work: type names, schemas, NULL clean-up. Every function is one projection."""
