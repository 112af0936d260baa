"""Readers and writers: raw landings, zones, warehouse tables and the benchmark-table adapter."""
