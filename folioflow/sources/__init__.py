"""Source tables, stored datasets, the load ledger and the field catalog."""
