"""The operators wired to the driver tables, and the SQL they are checked against."""
