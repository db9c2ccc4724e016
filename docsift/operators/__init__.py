"""DataFrame operators: joins, rankings, roll-ups and model calls."""
