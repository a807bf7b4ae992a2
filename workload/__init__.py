"""The registered workload: the events table as a feed, queries and their SQL."""
