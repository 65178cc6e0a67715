"""Metagenome profiling tables on Spark: sources, operators, plans and sinks as DataFrame functions."""
