"""Reading and writing tables, reports and manifests."""
