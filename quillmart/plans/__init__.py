"""End-to-end plans: the two marts and the daily job."""
