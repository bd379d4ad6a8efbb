"""Readers and writers: files, warehouse tables, keyed logs, control documents."""
