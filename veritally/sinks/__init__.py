"""Writers for metrics, reports and result tables."""
