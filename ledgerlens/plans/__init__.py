"""End-to-end plans: screening, warehouse, calendar."""
