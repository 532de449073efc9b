"""Files, manifests and tables of the shared folder."""
