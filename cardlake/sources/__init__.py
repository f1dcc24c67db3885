"""Reading and writing: landing files, tables, the ingest ledger, the sample adapter."""
