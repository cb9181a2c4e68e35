"""The layered model: scope, staging, dimensions, facts, extracts, metrics, checks."""
