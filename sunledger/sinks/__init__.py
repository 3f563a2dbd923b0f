"""Sinks: silver partitions, outgoing events, dead letters, quarantine, ledger."""
