"""DataFrame operators: raw normalisation, staging, checked broadcast joins, data quality."""
