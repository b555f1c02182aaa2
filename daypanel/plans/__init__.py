"""Multi-step plans: feature tables, model fits, the run log and the jobs built from them."""
