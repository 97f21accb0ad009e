"""Source tables, calendar, category documents and sinks."""
