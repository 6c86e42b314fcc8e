"""DataFrame -> DataFrame operators; the same functions serve tables and micro-batches."""
