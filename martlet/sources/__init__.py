"""Raw sources: CSV schemas and reader, layer tables, supplied-table adapter."""
