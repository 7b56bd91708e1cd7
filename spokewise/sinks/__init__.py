"""Writers for tables and models."""
