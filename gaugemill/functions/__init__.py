"""Column expressions: numbers, calendar, clock, text and JSON documents."""
