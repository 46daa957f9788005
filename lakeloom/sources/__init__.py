"""Tables with snapshots, connectors and adapters."""
