"""Sources and sinks: tables, reviews, key lists, models and the run registry."""
