"""Plans: office specs, version ledger, snapshots, updates, publishing."""
