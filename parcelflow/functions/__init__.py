"""Column expressions: JSON, Base64, Avro and envelope fields."""
