"""DataFrame -> DataFrame operators of the eligibility pipeline."""
