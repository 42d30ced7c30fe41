"""Writers: console, keyed topic publish, keyed upsert table with changelog,
summary topic, create-if-absent guards, constrained-load checks."""
