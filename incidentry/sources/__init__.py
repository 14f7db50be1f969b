"""Reading, writing and staging of tables and fitted models."""
