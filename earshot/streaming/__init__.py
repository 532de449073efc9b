"""Empty on purpose: every operator of the inventory is a batch job."""
