"""Stand-in entities, composed workloads, and the registered queries."""
