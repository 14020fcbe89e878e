"""Fixed values, schemas and column expressions."""
