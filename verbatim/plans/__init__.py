"""End-to-end flows: panel response tables, bigram reports, sinks, test-table queries."""
