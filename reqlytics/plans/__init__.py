"""The jobs a user calls: validation, load, layers, KPIs, quality checks."""
