"""Reading raw postings and seeds, writing layers, snapshots and run logs."""
