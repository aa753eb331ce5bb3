"""DataFrame operators, grouped by the kind of work they do."""
