"""Reading records and lookups, publishing and archiving."""
