"""DataFrame operators: staging queries, totals, events, merge, partitioning."""
