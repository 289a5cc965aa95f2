"""DataFrame-to-DataFrame operators; nothing here does I/O except explicit pinning."""
