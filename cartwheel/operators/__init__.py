"""DataFrame -> DataFrame operators, grouped by analytics area."""
