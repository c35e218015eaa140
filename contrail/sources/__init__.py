"""Files, tables and ledgers."""
