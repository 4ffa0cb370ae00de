"""Writers: versioned tables, batch-keyed appends, history tables, catalog entries, messages, CSV."""
