"""Analysis tables, cohorts and whole studies composed from the operators."""
