"""Sources: XML records, zip archives, landing inventory, manifests, seeds."""
