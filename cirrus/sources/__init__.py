"""Sources and sinks: raw line files, JSON readings (batch / stream),
message-bus adapters, literal tables and keyed result tables."""
