"""Reading releases and lookups, writing layers and manifests."""
